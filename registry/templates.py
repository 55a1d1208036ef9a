"""Shapes of model completions, filled with the whole text and the lines of every document.

{W} the text as one line, {J} the same inside a JSON string, {T} its whole text, {S} all its lines as numbered steps,
{L} all its lines as plain step sentences. Columns: completion, c1, c2, c3.
"""

STEPS = "Go to the {W} group page\nClick [Add] to create the {W} group\nEnter the name of the {W} group\nClick [Save] to keep the {W} group"
GOOD = (
    "1. Go to the {W} group page\n2. Click [Add] to create the {W} group\n"
    "3. Enter the name of the {W} group\n4. Click [Save] to keep the {W} group"
)
JGOOD = GOOD.replace("\n", "\\n").replace("{W}", "{J}")
LONG = (
    "1. Open the yearly budget overview from the main navigation menu on the left side\n"
    "2. Choose every department whose figures belong into the final summary table below\n"
    "3. Compare planned amounts with actual spending while keeping rounding differences small\n"
    "4. Submit the finished comparison together with comments explaining each larger deviation"
)

TEMPLATES = [
    ("Q: How do I create a {W} group?\nA:\n" + GOOD, STEPS, "More about {W}.", ""),
    ('[{"question": "How do I create the {J} group?", "ans": "' + JGOOD + '"}]', STEPS, "More about {W}.", ""),
    ('[{"question": "How do I create one {J} group?", "ans": "' + JGOOD + '"}, '
     '{"question": "What about {J}?", "ans": "Make the necessary changes to {J}."}]', STEPS, "", ""),
    ('[{"question": "How do I add {J}?", "ans": ', STEPS, "", ""),
    ("Q1: How do I create some {W} group?\nA1:\n" + GOOD + "\n\nQ2: How do I search the {W} listing?\n"
     "A2:\n1. Open the {W} listing of the tool\n2. Search the {W} listing by name", "", "", ""),
    ("Q: How do I open {W}?\nA: ***\n. .\nclick .", "", "", ""),
    ("Q: Where is the {W} list?\nA: Refer to the table for the {W} list", "", "", ""),
    ("Q: How do I open the {W} page?\nA:\n1. Open the {W} page\nSection 4\n2. Close the {W} page", "", "", ""),
    ("Q: How do I open a {W} page?\nA:\n1. Open the {W} page\nGENERAL SETTINGS\n2. Close the {W} page", "", "", ""),
    ("Q: How do I keep the {W} page?\nA:\n1. Open the {W} page\n2. Press **Save** on the {W} page", "", "", ""),
    ("Q: How do I store the {W} page?\nA:\n1. Open the {W} page of the tool\n2. Click . on the {W} page", "", "The Save label stands below.", ""),
    ("Q: How do I store one {W} page?\nA:\n1. Open the {W} page of the tool\n2. Click . on the {W} page", "", "Nothing of use is here.", ""),
    ("Q: How do I pass the {W} page?\nA:\n1. Open the {W} page of the tool\n2. Press . on the {W} page", "", "The NEXT_STEP9 label of GO", ""),
    ("Q: How do I fill in the {W} form?\nA:\n1. Open the {W} form\n2. Enter the required details of the {W} form", "", "", ""),
    ("Q: How do I see the {W} form?\nA:\n1. Look at the {W} form", "", "", ""),
    ("Q: Why?\nA:\n1. Open page {W}\n2. Look at page {W}", "", "", ""),
    ("Q: How do I close the {W} form?\nA:\n1. Open the {W} form\n2. Close the {W} form\n3. close the {W} form", "", "", ""),
    ("Q: How do I store the {W} record?\nA:\n1. Open the {W} record\n2. Store the {W} record\nThe record saved message is shown", "", "1. Click the {W} row\n2. Go on", ""),
    ("Q: How do I delete the {W} record?\nA: The {W} record goes away after the page of {W} is closed", "", "", ""),
    ("Q: How can I set up the {W} entry?\nA: Use create parameter for the {W} entry set up", "", "", ""),
    ("Q: What is the {W} page?\nA: The {W} page is a part of the tool", "", "", ""),
    ("Q: What is on the {W} page?\nA:\n1. Open the {W} page of the tool\n2. Choose one of the following {W} page parts:", "", "", ""),
    ("Q: How do I leave the {W} page?\nA:\n1. Open the {W} page of the tool\n2. Leave page", "", "", ""),
    ("Q: How do I create an old {W} group?\nA:\n" + GOOD, "Open the other page first\nChoose another entry there\nClick [OK] at the very end", "", ""),
    ("Q: How do I read the {W} page?\nA:\n1. Go to the {W} page and read it\n2. Choose the {W} entry from the list", "Go to the {W} page and read it", "", "Choose the {W} entry from the list"),
    ("Q: How do I create a last {W} group?\nA:\n" + GOOD, STEPS, "", "1. Click [Save] again on the page after that"),
    ("Q: How do I add or remove a {W} user?\nA:\n1. Go to the user page of {W}\n2. Move right the {W} name to add it\n"
     "3. Remove the {W} name from the list\n4. Save the {W} user page of the tool", "", "", ""),
    ("Q: How do I send the {W} form?\nA:\n- Go to the {W} page now\n- Choose the {W} entry there\n* Submit the {W} form at once", "", "", ""),
    ("Q: How do I choose a {W} type?\nA:\n1. Choose a {W} type: * alpha one * beta two\n2. Submit the {W} type form at once", "", "", ""),
    ("Q: How do I order the {W} types?\nA:\n1. Open the {W} types of the tool\n3. Order the {W} types by name\n7. Submit the {W} types at once", "", "", ""),
    ("Q: How do I see the {W} types?\nA:\n1. Open the {W} types <image 3> of the tool\n2. Click here to see the {W} types", "", "", ""),
    ("Q: How do I see all {W} types?\nA:\n1. Open the {W} types of the tool\n2. Search all {W} types by name\nNote: the extracted Q&A pairs are above", "", "", ""),
    ("Q: How do I see no {W} types?\nA:\n1. Open the {W} types of the tool\nNote: this is background\nNote- you must select the {W} types\n2. Search no {W} types by name...", "", "", ""),
    ("Q: What does the page about {W} say?\nA: {T}", "{T}", "{T}", ""),
    ("Q: How do I go through {W} to open the document?\nA:\n{S}", "{L}", "", ""),
    ("Q: How do I see few {W} types?\nA:\n1. Open the {W} types of the tool\n2.\n3. Search few {W} types by name", "", "", "{L}"),
    ("Q: How do I export the {W} report list?\nA:\n1. Open the {W} report list of the tool\n2. Submit the export of the {W} report list", "", "", ""),
    ("Q: How do I open the monthly summary report page with customer account list inside our web application using browser after login {W}?\n"
     "A:\n1. Open the monthly report page {W} first\n2. Submit the account list {W} afterwards", "", "", ""),
    ("Q: How do I submit a {W} budget overview comparison?\nA:\n" + LONG, "", "", ""),
    ("Q: How do I edit the {W} toolbar?\nA:\n1. Open the {W} toolbar or the {W} tab\n2. Edit the {W} toolbar in the pop-up\n"
     "3. Submit the {W} toolbar, an error is shown when it is invalid", "", "", ""),
]
assert len(TEMPLATES) == 40
