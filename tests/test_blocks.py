import math

from pyspark.sql import functions as F

from qaloom import Rules
from qaloom.operators import blocks

PAGE = (
    '<html><head><style>p{}</style><script>var t="</p><p>no";</script></head><body><!-- <p>no</p> -->'
    "<p>intro</p><h1>One</h1><p>a <b>bold</b><br>b &amp;lt;</p><h2 class='x'>Two</h2><ul><li>i1</li><li>i2</li></ul>"
    "<h3>Deep</h3><p>deep</p><h2>Three</h2><p> </p><P>end</P></body></html>"
)


def test_headings_above_elements(spark):
    df = spark.createDataFrame([(PAGE,), (None,), ("no markup",)], "html string")
    rows = [r["v"] for r in df.select(blocks.under_headings(blocks.html_elements(F.col("html"))).alias("v")).collect()]
    assert [(b["headings"], b["text"]) for b in rows[0]] == [
        ("", "intro"), ("One", "a bold b &lt;"), ("One > Two", "i1"), ("One > Two", "i2"),
        ("One > Two > Deep", "deep"), ("One > Three", "end"),
    ]
    assert rows[1] is None and [b["text"] for b in rows[2]] == ["no markup"]


def test_no_text_is_lost(spark):
    page = (
        "<p>Press <kbd>F1</kbd> to open the help.</p><div>Loose text</div><table><tr><td>cell</td></tr></table><pre>code</pre>"
        "<p>It&#8217;s <abbr>UI</abbr> text, 1 < 2 &eacute;&#x1F600;&#0;&none;&amp;gt;</p>tail<li><p>in</p>out"
    )
    got = spark.createDataFrame([(page,)], "html string").select(blocks.html_elements(F.col("html")).alias("v")).head()["v"]
    assert [(e["tag"], e["text"]) for e in got] == [
        ("p", "Press F1 to open the help."), ("p", "Loose text"), ("p", "cell"), ("p", "code"),
        ("p", "It\u2019s UI text, 1 < 2 \u00e9\U0001F600\ufffd&none;&gt;"), ("p", "tail"), ("p", "in"), ("p", "out"),
    ]


def test_budget(spark):
    df = spark.createDataFrame([(1, PAGE), (2, "<h1>T</h1><p>" + "x" * 95 + "</p><p>" + "y" * 15 + "</p><p>" + "z" * 20 + "</p>")], "id int, html string")
    got = sorted((r["id"], r["chunk_idx"], r["text"]) for r in blocks.html_chunks(df, "id", "html", Rules(chunk_tokens=10)).collect())
    assert got == [
        (1, 0, "intro"), (1, 1, "One\na bold b &lt;"), (1, 2, "One > Two\ni1\ni2"), (1, 3, "One > Two > Deep\ndeep"), (1, 4, "One > Three\nend"),
        (2, 0, "T\n" + "x" * 40), (2, 1, "T\n" + "x" * 40), (2, 2, "T\n" + "x" * 15 + "\n" + "y" * 15), (2, 3, "T\n" + "z" * 20),
    ]


def test_element_text(spark):
    schema = "e array<struct<category:string,text:string>>"
    rows = [([("Title", "T"), ("Footer", "no"), ("ListItem", "* -"), ("NarrativeText", None), ("NarrativeText", "n..")],), (None,), ([],)]
    got = [r["v"] for r in spark.createDataFrame(rows, schema).select(blocks.element_text(F.col("e")).alias("v")).collect()]
    assert got == ["T\nn.", "", ""]


def reference_chunks(text, rules):
    """Plain two-pass fold over sentences."""
    import re

    def similar(a, b):
        x, y = (set(re.findall(r"[^\W_]+", s.lower())) for s in (a, b))
        return len(x & y) / math.sqrt(len(x) * len(y)) if x and y else 0.0

    parts = [s.strip() for s in re.split(r"\n+", re.sub(r"([.!?])\s+", "\\1\n", text)) if s.strip()]
    groups = []
    for s in parts:
        if groups:
            g = groups[-1]
            needed = rules.initial_threshold if len(g) == 1 else rules.appending_threshold
            if len(" ".join(g)) + len(s) + 1 <= rules.max_chunk_chars and similar("\n".join(g[-2:]), s) >= needed:
                g.append(s)
                continue
        groups.append([s])
    out = []
    for c in (" ".join(g) for g in groups):
        if out and len(out[-1]) + len(c) + 1 <= rules.max_chunk_chars and similar(out[-1], c) >= rules.merging_threshold:
            out[-1] += " " + c
        else:
            out.append(c)
    return out


def test_similarity_chunks(spark):
    texts = ["The cat sat. The cat ran! A dog ran.\n\nOther words here. Other words there. The cat sat. The cat sat again.", "", "One", "a b. a b c. a b c d. x. x y."]
    rules = Rules(initial_threshold=0.5, appending_threshold=0.4, merging_threshold=0.2, max_chunk_chars=40)
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, t string")
    got = [r["v"] for r in df.select("i", blocks.similarity_chunks(F.col("t"), rules).alias("v")).orderBy("i").collect()]
    assert got == [reference_chunks(x, rules) for x in texts]
