import pytest

from lexiflow.functions import readings as R


@pytest.mark.parametrize(
    "numbered, marked",
    [
        ("shang4 ji2", "shàng jí"), ("gui4", "guì"), ("liu2", "liú"), ("xue2", "xué"), ("gou3", "gǒu"), ("yi1 ge5", "yī ge"), ("nu:3 hai2 zi5", "nǚ hái zi"), ("Lu:4", "Lǜ"),
        ("11 Qu1", "11 Qū"), ("san1 C", "sān C"), ("yi1 shi4 yi1 , er4 shi4 er4", "yī shì yī, èr shì èr"), ("Jia1 li4 lu:e4 · lei2", "Jiā lì lüè · léi"),
        ("m2", "ḿ"), ("ng2", "ńg"), ("hng5", "hng"), ("yi1mo2-yi1yang4", "yī mó-yī yàng"), ("xx5", "xx"),
    ],
)
def test_marks(numbered, marked):
    assert R.to_marks(numbered) == marked


def test_keys_agree_across_spellings():
    for a, b in [("shàng jí", "shang4 ji2"), ("nǚ hái zi", "nu:3 hai2 zi5"), ("Měiguó", "Mei3 guo2"), ("xī'ān", "xi1 an1"), ("yī ge", "yi1 ge5"), ("guī ˙nü", "guī nü")]:
        assert R.key(a) == R.key(b)
    assert R.key("yī gè") != R.key("yí gè")
    assert R.key("shang4 ji2") == "sha4ngji2"
    assert R.toneless_key("yí gè") == R.toneless_key("yi1 ge5") != R.toneless_key("yí gù")


@pytest.mark.parametrize(
    "source, heard, same",
    [("yi1 lu4", "yí lù", True), ("bu4 shi4", "bú shì", True), ("yi1 dian3 yi1 di1", "yìdiǎn yīdī", True), ("yi1 chang2 kong1", "yī chǎng kōng", False), ("yi1 ge5", "yí gè", False), ("bu4 an1 fen5", "bù ān fèn", False), ("ke3 bu5", "kěbù", False), ("ying1 xiong2", "yíng xióng", False)],
)
def test_sandhi_as_an_equality_of_keys(source, heard, same):
    matched = R.key(source) == R.key(heard) or (R.starts_with_sandhi(source) and R.sandhi_key(source) == R.heard_sandhi_key(heard))
    assert matched is same


def test_column_form(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("shang4 ji2",), (None,)], "r string")
    assert [tuple(r) for r in df.select(R.column(R.to_marks)("r")).collect()] == [("shàng jí",), (None,)]
