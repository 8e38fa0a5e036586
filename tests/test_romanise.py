import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tonehive.functions import romanise as r

DEFAULT = r.Options()
# Inputs and the outputs that they must have.
CASES = [
    # basic
    ("phah", "phah", {}), ("Tâi-uân", "Tâi-oân", {}), ("tsuí", "chúi", {}), ("tshuí", "chhúi", {}), ("ing", "eng", {}), ("tsa", "cha", {}), ("ua", "oa", {}), ("ue", "oe", {}),
    # oo
    ("óo", "ó͘", {}), ("oo", "o͘", {}), ("Oo", "O͘", {}), ("ōo", "ō͘", {}),
    # nasal
    ("siann", "siaⁿ", {}), ("Siann", "Siaⁿ", {}), ("hnn", "hⁿ", {}), ("Hnn", "Hⁿ", {}), ("mng", "mng", {}), ("ng", "ng", {}), ("ann", "aⁿ", {}),
    ("aN", "aⁿ", {"nasal": True}), ("aN", "aN", {"nasal": False}), ("annh", "ahⁿ", {}), ("innh", "ihⁿ", {}), ("aNh", "ahⁿ", {"nasal": True}), ("aNh", "aNh", {"nasal": False}),
    # tone 6
    ("si6", "sí", {}), ("si6", "sǐ", {"tone6_caron": True}),
    # capitals
    ("TSUI", "CHUI", {}), ("TSUI", "TSUI", {"capitals": False}), ("TSHUI", "CHHUI", {}), ("UAN", "OAN", {}), ("OO", "O͘", {}),
    # untouched
    ("123", "123", {}), ("Hello (Tâi-gí)!", "Hello (Tâi-gí)!", {}), ("html", "html", {}),
    # escapes
    (r"\[Tâi-uân\]", "Tâi-uân", {}), (r"\[tsuí\]", "tsuí", {}), ("\\[line 1\nline 2\\]", "line 1\nline 2", {}), (r"\[no closing", "no closing", {}),
    (r"\[first \[ second\] rest", r"first \[ second rest", {}), (r"a tsuí \[tsuí\] b", "a chúi tsuí b", {}), (r"\[arr[0]\]", "arr[0]", {}),
    # already in the target spelling
    ("chiâⁿ", "chiâⁿ", {}), ("siaⁿ", "siaⁿ", {}), ("koaⁿ", "koaⁿ", {}), ("hó͘", "hó͘", {}), ("gô͘", "gô͘", {}), ("o͘", "o͘", {}),
    ("chiâⁿ tsuí", "chiâⁿ chúi", {}), ("hó͘ oo", "hó͘ o͘", {}), ("Chiâⁿ", "Chiâⁿ", {}), ("Ô͘", "Ô͘", {}),
    # edge behaviour that is kept
    ("m̍", "m8", {}), ("n̍g", "ng8", {}), ("A1", "A", {}), ("i5", "î", {}), ("tâigí", "taig5í", {}), ("siann的", "siann的", {}), (r"\[x\](y)", r"\[x\](y)", {}),
    # links, nested ones come back whole
    ("see https://a.b/ue?x=ing now ue", "see https://a.b/ue?x=ing now oe", {}), ("[![ua](i.png)](ue)", "[![ua](i.png)](ue)", {}), ("⟪POJ9⟫", "⟪POJ9⟫", {}),
    # tones 3, 4, 8, 9
    ("kàu", "kàu", {}), ("kap4", "kap", {}), ("tsi̍t", "chi̍t", {}), ("pha̋ng", "phăng", {}), ("", "", {}), (None, None, {}),
]


@pytest.mark.parametrize(("text", "expected", "options"), CASES)
def test_goldens(text, expected, options):
    assert r.Converter(r.Options(**options))(text) == expected


def test_stage_options():
    assert r.to_digits("siann", nasal="N") == "siaN"
    assert r.to_digits("tsa phah", show_1_4=True) == "tsa1 phah4"
    assert r.digits_a_to_b("tsa1 phah4") == "cha phah"
    assert r.digits_a_to_b("tsa1 phah4", keep_1_4=True) == "cha1 phah4"
    assert r.to_digits("a\u0301") == "a\u0301"  # decomposed input is left as it is


def test_number_of_rules():
    assert len(r.marks_to_digits()) == 112 + 3
    assert len(r.a_to_b(DEFAULT)) == 2 + 15 + 9
    assert len(r.digits_to_marks(DEFAULT)) == 3 + 195 + 9


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aeioumnghptkstTSNGH123456789 -óòôőâⁿ\u0358\u030d的[]()\\", max_size=30))
def test_memo_is_exact(text):
    whole = text
    for stage in (r.marks_to_digits(), r.a_to_b(DEFAULT), r.digits_to_marks(DEFAULT)):
        for pattern, to in (x.compiled() for x in stage):
            whole = pattern.sub(to, whole)
    assert r.Converter().tokens(text) == whole


def test_spark_column_and_native_stage(spark):
    words = [c[0] for c in CASES if not c[2]]
    df = spark.createDataFrame([(w,) for w in words], "t string")
    got = df.select("t", r.convert("t").alias("c"), r.native(df.t, r.a_to_b(DEFAULT)).alias("n")).collect()
    for row in got:
        assert row.c == r.convert_text(row.t)
        assert row.n == r.digits_a_to_b(row.t)
    r.register(spark)
    assert spark.sql("select convert_roman('tsuí')").first()[0] == "chúi"


def test_native_marks_to_digits_passes_over_rules(spark):
    rules = r.marks_to_digits()
    texts = ["", None, "plain", "漢字 abc", *(x.pattern.split("(")[0] + rest for x in rules for rest in ("", "nnh x", "é á"))]
    texts += ["éá", "áé", "ó͘ ô͘nn o͘ O͘", "n̂g m̄ ń", "é" * 40 + "ⁿ", *(c[0] for c in CASES)]
    df = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n long, t string")
    stage = r.native(F.col("t"), rules)
    assert "filter" in str(stage)
    for row in df.select("t", stage.alias("got")).collect():
        assert row.got == r.to_digits(row.t)


def test_memo_is_bounded(spark):
    one = r.Converter(memo=10)
    words = [f"tsu{n}" for n in range(100)] + ["tsuí" * 1000]
    for w in [*words, *words]:
        assert one.tokens(w) == r.Converter().tokens(w)
        one.tokens("tsuí")
        kept = one._tokens
        assert "tsuí" in {**kept, **kept._older} and len(kept) + len(kept._older) <= 20 and max(map(len, kept)) <= r.LONGEST
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(64 << 20))
    r.convert("t")
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 8 << 20
