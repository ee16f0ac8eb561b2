"""Golden cases of the scalar functions."""

import math

import pytest
from pyspark.sql import functions as F

from quillmesh.functions import text, value, vector

NAME_CASES = [("Шланг 50мм 10 м", "Шланг"), ("Блок NV1150 2x5", "Блок NV1150"), ("Линзы -2.50", "Линзы -"), ("NV1150 мм", "NV"), (None, "")]
NUMERIC_CASES = [
    ("1.5 кВт", None, (1500.0, "w")), ("1,5 л", None, (1.5, "l")), ("3 шт", None, (3.0, "pcs")), ("три", None, (3.0, "pcs")), ("10 м", None, (10.0, "m")), ("500", "мл", (0.5, "l")),
    ("5 xyz", None, (5.0, "")), ("-2.5", None, (2.5, "")), ("5 м3", None, (5.0, "m")), ("", None, None), ("abc", None, None), (None, None, None), ("15", None, (15.0, "")),
]


def one(spark, column, **values):
    kinds = ", ".join(f"{k} {'double' if isinstance(v, float) else 'array<string>' if isinstance(v, list) else 'string'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], kinds).select(column.alias("r")).first()["r"]


def test_normalize(spark):
    assert one(spark, text.normalize_text("x"), x="Дрель-шуруповёрт 18В, 2шт!") == "дрель-шуруповёрт 18в 2шт"
    assert one(spark, text.normalize_text("x"), x="Étion") == "tion"
    for raw, want in [("Bosch GmbH", "bosch"), ("ООО Ромашка", "ооо ромашка"), ("Brand#2", "brand2"), (None, "")]:
        assert one(spark, text.normalize_brand("x"), x=raw) == want


@pytest.mark.parametrize("raw,want", NAME_CASES)
def test_strip_numbers(spark, raw, want):
    assert one(spark, text.strip_numbers("x"), x=raw) == want


def test_tokens_and_attrs(spark):
    assert one(spark, text.tokenize("x"), x="Bosch GSR 12 2") == ["bosch", "gsr", "12"]
    assert one(spark, text.tokenize("x"), x=None) == []
    for raw, want in [("500 мл", {"мл": 500.0}), ("1.5 л", {"л": 5.0}), ("10 м 20 м", {"м": 10.0}), ("", {})]:
        assert one(spark, text.numeric_attrs("x"), x=raw) == want
    assert one(spark, text.token_overlap("a", "b"), a=["a", "b"], b=["b", "c"]) == pytest.approx(1 / 3)
    assert one(spark, text.token_overlap("a", "b"), a=[], b=["a"]) == 0.0
    assert one(spark, text.brand_match("a", "b"), a="Brand#2", b="Brand#24") == 0.5 and one(spark, text.brand_match("a", "b"), a="", b="x") == 0.0
    assert one(spark, text.price_ratio("a", "b"), a=100.0, b=25.0) == 4.0 and one(spark, text.price_ratio("a", "b"), a=0.0, b=5.0) == 1.0


@pytest.mark.parametrize("raw,hint,want", NUMERIC_CASES)
def test_canon_numeric(spark, raw, hint, want):
    got = one(spark, value.canon_numeric("x", F.lit(hint) if hint else None), x=raw)
    assert (got and (pytest.approx(got["value"]), got["dimension"])) == (want and (want[0], want[1]))


def test_canon_rest(spark):
    assert one(spark, value.canon_string("x"), x="Щётка!") == "щетка" and one(spark, value.canon_string("x"), x="A-B") == "a b" and one(spark, value.canon_string("x"), x=None) == ""
    assert one(spark, value.canon_string("x"), x="ﬁx²") == "fix2"
    assert one(spark, value.canon_number("x")["value"], x=-2.5) == -2.5
    for v, t, want in [(117.0, 2.0, 116.0), (118.0, 2.0, 118.0), (119.0, 2.0, 120.0), (1.234, None, 1.23), (82.0, 0.05, 82.0), (83.0, 0.05, 83.0)]:
        assert one(spark, value.bucket("v", F.lit(t).cast("double")), v=v) == pytest.approx(want)
    assert one(spark, value.tolerance_of("x", True), x="items_count") == 1.03 and one(spark, value.tolerance_of("x"), x="items_count") == 1.15


def test_numbers_match(spark):
    for name, other, want in [("Набор 118 предметов", "118 шт", True), ("Модель 2024", "x", True), ("Шланг 50м", "100 м", False)]:
        assert one(spark, text.numbers_match("a", "b"), a=name, b=other) is want
    assert one(spark, text.better_reading("a", "b", "c"), a="x 118", b="11B", c="118") == "118"


def test_reasons_and_urls(spark):
    assert one(spark, text.contradicts("x"), x="Длина НЕ совпадает") and not one(spark, text.contradicts("x"), x="то же самое")
    assert one(spark, text.full_url("x"), x="//a/b") == "https://a/b" and one(spark, text.image_url("x"), x="a/c246x328/1") == "https://a/c516x688/1"


def test_vectors(spark):
    v = spark.createDataFrame([([3.0, 4.0], [0.0, 0.0])], "a array<float>, z array<float>")
    r = v.select(vector.norm("a"), vector.cosine("a", "z"), vector.unit("a"), vector.unit("z")).first()
    assert r[0] == 5.0 and r[1] == 0.0 and r[2] == [pytest.approx(0.6), pytest.approx(0.8)] and r[3] == [0.0, 0.0]
    assert one(spark, vector.sigmoid("x"), x=0.0) == 0.5 and math.isclose(one(spark, vector.sigmoid("x"), x=1.0), 1 / (1 + math.exp(-1)))
