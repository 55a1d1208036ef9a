"""The SQL of the URL filter against the query, where hosts without labels are judged by their domain or suffix."""

import duckdb
import pandas as pd

from qaloom.llm import reputation
from qaloom.llm.oracles import ORACLES


def test_sql_judges_unlabelled_hosts_alike(spark):
    hosts = [f"h{i}.{d}" for d in ("bad.com", "good.com", "x.co.uk", "1.2.3") for i in range(25)]
    rows = [(n, f"http://{h}/") for n, h in enumerate(h for h in hosts for _ in range(5))]
    new = ["new.bad.com", "new.good.com", "new.other.com", "a.zz", "n.x.co.uk", "n.y.co.uk", "q.net", "9.9.9.9"]
    rows += [(9000 + i, f"http://{h}/") for i, h in enumerate(new)] + [(9100, None), (9101, "no"), (9102, "http://new.bad.com/de/")]
    labels = [(n, int("bad" not in u), int(n % 7 == 0)) for n, u in rows if n < 9000]
    con = duckdb.connect()
    con.register("pages", pd.DataFrame(rows, columns=["page_id", "url"]))
    con.register("labels", pd.DataFrame(labels, columns=["doc_id", "quality", "toxic"]))
    want = con.sql(f"SELECT page_id, host, path, rule, verdict FROM ({ORACLES['op7_url_filter']})").fetchall()
    outcomes = spark.createDataFrame([(n, int(q == 0 or t == 1)) for n, q, t in labels], "page_id bigint, bad bigint")
    got = reputation.judge(spark.createDataFrame(rows, "page_id bigint, url string"), outcomes)
    got = [tuple(r) for r in got.select("page_id", "host", "path", "rule", "verdict").collect()]
    assert sorted(got) == sorted(want)
    verdict = {h: v for _, h, _, _, v in got}
    assert verdict["new.bad.com"] == "block" and verdict["new.good.com"] == verdict["a.zz"] == "allow"
