"""Tokens of scripts without spaces against a plain count."""

import re

from tidewater.functions import all_script_tokens_match, script_keyword_tokens, script_tokens, token_list

TEXTS = [
    "红色戒指", "热齿轮 Gizmo-7 新", "ring红色", "さくらラーメン", "ภาษาไทย", "café au lait", "一", "", None, "!!", "𠮷野家", "Red ring", "红 色",
]
SPACELESS = "一-鿿\U00020000-\U0002a6dfぁ-ゖァ-ヺーก-ฺเ-๛"


def runs(text):
    return re.findall(f"[{SPACELESS}]+|[^\\W_{SPACELESS}]+", (text or "").lower())


def expected(text, keyword=False):
    out = []
    for r in runs(text):
        if not re.match(f"[{SPACELESS}]", r):
            out.append(r)
            continue
        pairs = [a + b for a, b in zip(r, r[1:], strict=False)]
        out += (pairs or [r]) if keyword else [*r, *pairs]
    return list(dict.fromkeys(out)) if keyword else out


def test_tokens_of_texts_and_keywords(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")
    for r in df.select("i", "t", script_tokens("t").alias("x"), script_keyword_tokens("t").alias("k")).collect():
        assert r["x"] == (None if r["t"] is None else expected(r["t"])), r["t"]
        assert r["k"] == (None if r["t"] is None else expected(r["t"], True)), r["t"]


def test_texts_with_spaces_have_the_same_tokens_as_before(spark):
    df = spark.createDataFrame([("small Red-ring 7", ), ("a_b  c",), ("café é",)], "t string")
    assert all(r[0] == r[1] for r in df.select(script_tokens("t"), token_list("t")).collect())


def test_match_needs_neighbours(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")

    def match(keyword):
        return {r["t"] for r in df.where(all_script_tokens_match("t", keyword)).collect()}

    assert match("红色") == {"红色戒指", "ring红色"}
    assert match("红戒") == set()  # both characters, no neighbours
    assert match("红") == {"红色戒指", "ring红色", "红 色"}
    assert match("RING 红色") == {"ring红色"}
    assert match("") == set() and match("?") == set()


def test_a_long_run_takes_linear_time(spark):
    df = spark.range(1).selectExpr("repeat('红色戒指', 50000) as t").select(script_tokens("t").alias("x"))
    assert df.selectExpr("size(x)").first()[0] == 200_000 + 199_999
