"""Numbers with a country keep it, however many digits they have."""

import re

from lexiflow.llm import pii


def test_ten_digits_behind_a_plus_are_no_american_number(spark):
    said = ["call +49 30 123456 now", "call +33 1 23 45 67 89", "call (212) 555-0199", "call +1 212 555 0199"]
    df = spark.createDataFrame(list(enumerate(said)), "doc_id int, text string")
    found = {r["doc_id"]: r["text"] for r in pii.pseudonymise(df).collect()}
    assert found[0].startswith("call +49 ") and re.fullmatch(r"call \+49 \d\d \d{6} now", found[0]) and found[0] != said[0]
    assert found[1].startswith("call +33 ") and found[1] != said[1]
    assert re.fullmatch(r"call \([2-9]\d\d\) [2-9]\d\d-\d{4}", found[2]) and found[3].startswith("call +1 ")
