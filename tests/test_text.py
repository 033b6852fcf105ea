"""Golden vectors of the normalisers and token sets."""

import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from linkwright.functions import text as N
from linkwright.functions import tokens as T

NAMES = {
    "Northwind Corp.": "northwind",
    "Lotus Data Services Private Limited": "lotus data services",
    "Tom & Anna's Fruit Juice LLC": "tom and anna fruit juice",
    "CAFÉ ÉTOILE SA": "cafe etoile sa",
    "primemoney.com": "primemoney com",
    "@home Pvt. Ltd.": "ahome",
    "A.B.C. Company": "a b c",
    "Limited Edition Inc": "edition",
    "Foo-Ltd": "foo",
    "X & Y aka Z": "x and y z",
    "private dba limited": "",
    "private company limited": "private",
    "Straße": "strae",
    "L’Oréal": "loreal",
    "प्राइवेट": "",
    "a_b": "a_b",
    "": "",
    None: "",
}
ADDRESSES = {
    "77 Oak St, Suite 9, Springfield, NY": "77 oak street springfield ny",
    "PLOT NO. -12/7, OLD MILL, Mill": "plot no -12 7 old mill mill",
    "0337 Sterling Ave": "337 avenue",
    "Miami, FL 33101": "miami",
    "United Plaza, 5th Floor, Pune": "plaza 5th",
    "3rd Floor": "3rd",
    "Suite": "suite",
    "12 N Elm Ct": "12 north elm court",
}


def column(spark, values, f):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r[0] for r in df.orderBy("i").select(f(F.col("x"))).collect()]


def test_names(spark):
    assert column(spark, NAMES, N.normalize_name) == list(NAMES.values())


def test_addresses(spark):
    assert column(spark, ADDRESSES, N.normalize_address) == list(ADDRESSES.values())


def test_country(spark):
    assert column(spark, ["  FRance ", "Österreich", None, ""], N.normalize_country) == ["france", "österreich", "", ""]


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=st.characters(blacklist_categories=("Cs",), blacklist_characters="\0"), max_size=20), min_size=20, max_size=60))
def test_fold_equals_decomposition(spark, values):
    values += ["½ ™ ﬁ ß ø ’ é", "Ａ１", "㎏", "ᄀ가", "𝐀𝟙", "İ"]
    want = [unicodedata.normalize("NFKD", v).encode("ascii", "ignore").decode() for v in values]
    assert column(spark, values, N.ascii_fold) == want


def test_fold_of_every_character(spark):
    values = [chr(i) for i in range(1, 0x30000) if not 0xD800 <= i < 0xE000]
    values = ["".join(values[i : i + 500]) for i in range(0, len(values), 500)]
    want = [unicodedata.normalize("NFKD", v).encode("ascii", "ignore").decode() for v in values]
    assert column(spark, values, N.ascii_fold) == want


def test_normalizing_twice_changes_nothing(spark):
    once = column(spark, [*NAMES, *ADDRESSES], N.normalize_text)
    assert column(spark, once, N.normalize_text) == once


@pytest.mark.parametrize(
    "f, x, want",
    [
        (T.name_tokens, "the bank of la paz x", {"bank", "paz"}),
        (T.address_tokens, "1 northwind way no 22", {"northwind", "way", "22"}),
        (T.char_ngrams, "ab", {"ab"}),
        (T.char_ngrams, "", set()),
        (T.char_ngrams, "abcd", {"abc", "bcd"}),
    ],
)
def test_sets(spark, f, x, want):
    got = column(spark, [x], f)[0]
    assert set(got) == want and len(got) == len(want)


def test_significant_and_padded(spark):
    df = spark.createDataFrame([("lotus steel ltd", "12 main road 7 west delhi")], "n string, a string")
    assert set(df.select(T.significant_tokens(F.col("n"), F.col("a"))).first()[0]) == {"lotus", "steel", "12", "main", "delhi"}
    assert sorted(column(spark, ["ab c"], T.padded_ngrams)[0]) == sorted([" a", "ab", "b ", " ab", "ab ", " ab ", " c", "c ", " c "])
    assert column(spark, [""], T.padded_ngrams) == [[]]
