import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import inspection_fixtures as fixtures
from tamis.functions.text import blank_to_null, repair_encoding, standard_name
from tests.conftest import SF_DIR


def garble(text):
    """UTF-8 read as Latin-1."""
    return "".join(chr(b) for b in text.encode())


def one_column(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")


def apply(spark, values, expression):
    rows = one_column(spark, values).select("i", expression(F.col("v")).alias("v")).collect()
    return [r["v"] for r in sorted(rows)]


@pytest.mark.parametrize(
    "raw, expected",
    [
        (" P-PartKey ", "p_partkey"),
        ("Date d'inspection", "date_d_inspection"),
        ("__T. AV__", "t_av"),
        ("pièce", "pi_ce"),
        ("a___b--c", "a_b_c"),
        ("id", "id"),
        ("é", ""),
    ],
)
def test_standard_name(raw, expected):
    assert standard_name(raw) == expected


@given(st.text())
def test_standard_name_is_idempotent(name):
    assert standard_name(standard_name(name)) == standard_name(name)


def test_blank_to_null_trims_spaces_only(spark):
    given_texts = ["  a b ", "   ", "", None, "\tx ", " "]
    assert apply(spark, given_texts, blank_to_null) == ["a b", None, None, None, "\tx", " "]
    twice = apply(spark, given_texts, lambda c: blank_to_null(blank_to_null(c)))
    assert twice == ["a b", None, None, None, "\tx", " "]


def test_repair_encoding_examples(spark):
    texts = ["DÃ©chargement", "Déchargement", "日本", "plain", "", None, "Ã", "â\x82¬", "\x80", "é日"]
    expected = ["Déchargement", "Déchargement", "日本", "plain", "", None, "Ã", "€", "\x80", "é日"]
    assert apply(spark, texts, repair_encoding) == expected


def test_every_pair_of_characters(spark):
    """Two characters change exactly if they are the two bytes of one character."""
    pairs = [chr(a) + chr(b) for a in range(1, 256) for b in range(128, 256)]
    whole = {garble(chr(c)): chr(c) for c in range(0x80, 0x800)}
    assert apply(spark, pairs, repair_encoding) == [whole.get(p, p) for p in pairs]


def test_broken_sequences_stay(spark):
    texts = ["\xed\xa0\x80", "\xc0\xaf", "\xe0\x80\xaf", "\xf4\x90\x80\x80", "\xf0\x9f\x98", "😀é", "é à №", "déjà"]
    texts += [t + "x" for t in texts]
    assert apply(spark, texts, repair_encoding) == texts


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=st.lists(st.text(st.characters(exclude_categories=("Cs",)), max_size=8), min_size=9))
def test_garbled_text_comes_back(spark, texts):
    assert apply(spark, [garble(t) for t in texts], repair_encoding) == texts


def test_whole_documents(spark):
    sound = [r["text"] for r in fixtures.table(spark, SF_DIR, "documents").select("text").collect()]
    once = [garble(t) for t in sound]
    twice = [garble(t) for t in once]
    assert apply(spark, sound + once + twice, repair_encoding) == sound + sound + once
