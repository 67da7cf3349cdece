"""Hand-made semantic rows (FIXTURES §B): nulls, traps, keyword modes."""

import unicodedata

import pytest
from pyspark.sql import functions as F

from reachset.functions.predicates import (
    any_value_in,
    check_code,
    is_multivalued,
    keyword_any,
    literal_prefix,
    matches,
    non_empty,
    none_value_is,
    not_equal,
    positive_id,
    same_code,
    two_letter_code,
)
from reachset.operators.algebra import audience, combine, exclude, in_all, in_any
from reachset.operators.shape import (
    EmptyAudienceError,
    cast_key,
    drop_incomplete,
    fill_defaults,
    rename,
    require_rows,
)
from reachset.plans.any_signal import TECH_KEYWORDS, reference_pattern
from reachset.plans.presets import MarketPreset, near_market


def keys(spark, values, name="k"):
    return spark.createDataFrame([(v,) for v in values], f"{name} bigint")


def col_values(df, c):
    return sorted((r[c] for r in df.collect()), key=lambda v: (v is None, v))


def test_full_join_drops_null_keys(spark):
    left = keys(spark, [1, 2, None]).withColumn("a", F.lit("x"))
    right = keys(spark, [2, None]).withColumn("b", F.lit("y"))
    out = combine(left, right, "k", how="full")
    assert col_values(out, "k") == [1, 2]


def test_anti_join_is_not_the_not_in_trap(spark):
    left = keys(spark, [1, 2, None])
    right = keys(spark, [2, None])
    out = exclude(left, right, "k")
    assert col_values(out, "k") == [1, None]
    left.createOrReplaceTempView("l")
    right.createOrReplaceTempView("r")
    assert spark.sql("select k from l where k not in (select k from r)").count() == 0


def test_int32_overflow_fails(spark):
    df = keys(spark, [2147483653])
    with pytest.raises(Exception) as exc:
        cast_key(df, "k").collect()
    assert "int32" in str(exc.value)


def test_int32_in_range(spark):
    df = keys(spark, [2147483647, -5, None])
    out = cast_key(df, "k", "accountId")
    assert out.schema["accountId"].dataType.simpleString() == "int"
    assert col_values(out, "accountId") == [-5, 2147483647, None]


def test_empty_string_is_not_null(spark):
    df = spark.createDataFrame([("", 1), (None, 2)], "s string, n int")
    assert [r.n for r in drop_incomplete(df).collect()] == [1]
    filled = fill_defaults(df, {"s": "dflt"}).orderBy("n").collect()
    assert [r.s for r in filled] == ["", "dflt"]


def test_ids_as_text(spark):
    df = spark.createDataFrame([(v,) for v in ["12", "0", "", "abc", None]], "id string")
    assert [r.id for r in df.where(positive_id("id")).collect()] == ["12"]


WORD_HITS = [
    "Vaga de TI",
    "java",
    "desenvolvedor.net jr",
    "desenvolvedor c# pleno",
    "Analista de Sistemas SÊNIOR",
]
WORD_MISSES = [
    "motivacao",
    "javascript",
    "desenvolvedorxnet",
    "êti",
    "flutterapp",
    "analista financeiro",
]


def _hits(spark, texts, pred_fn):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    return sorted(r.t for r in df.where(pred_fn("t")).collect())


def test_keywords_words_mode(spark):
    texts = WORD_HITS + WORD_MISSES
    got = _hits(spark, texts, lambda c: keyword_any(c, TECH_KEYWORDS))
    assert got == sorted(WORD_HITS)


def test_keywords_pattern_mode(spark):
    hits = ["ti", "tech", "area de tecnologia", "flutter", "flutters", "desenvolvedorxnet"]
    misses = ["techs", "java", "tecnologia x", "flutte", "motivacao"]
    got = _hits(
        spark, hits + misses, lambda c: keyword_any(c, reference_pattern(), mode="pattern")
    )
    assert got == sorted(hits)


def test_keywords_unicode_forms(spark):
    # no other keyword ('sistemas', 'ti', ...) occurs inside this one
    composed = unicodedata.normalize("NFC", "analista de inteligência de mercado")
    decomposed = unicodedata.normalize("NFD", composed)
    assert composed != decomposed
    both = [composed, decomposed]
    assert _hits(spark, both, lambda c: keyword_any(c, TECH_KEYWORDS)) == sorted(both)
    got = _hits(spark, both, lambda c: keyword_any(c, reference_pattern(), mode="pattern"))
    assert got == [decomposed]


def test_keywords_contains_mode(spark):
    got = _hits(spark, ["motivacao", "x"], lambda c: keyword_any(c, ["ti"], mode="contains"))
    assert got == ["motivacao"]


def test_full_match_not_find(spark):
    texts = ["sponsor", "sponsored_x", "nosponsor", "sponsor\nline"]
    assert literal_prefix("sponsor.*") == "sponsor"
    assert literal_prefix("spon.or.*") is None
    got = _hits(spark, texts, lambda c: matches(c, "sponsor.*"))
    assert got == sorted(["sponsor", "sponsored_x", "sponsor\nline"])
    got = _hits(spark, texts, lambda c: matches(c, "spons.r"))
    assert got == ["sponsor"]


def test_prefix_pattern_pushes_down(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.createDataFrame([("sponsor_a",), ("x",)], "tosheet string").write.parquet(path)
    plan = spark.read.parquet(path).where(matches("tosheet", "sponsor.*"))._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith" in plan


def test_precedence(spark):
    from reachset.functions.predicates import all_of, any_of

    rows = [
        (d, lvl, sv)
        for d in (0, 1)
        for lvl, sv in [
            ("organic", None),
            ("jobalert", None),
            ("sponsored", "spon_active"),
            ("sponsored", "other"),
        ]
    ]
    df = spark.createDataFrame(rows, "dupeStatus int, lvl string, sv string")
    cond = all_of(
        F.col("dupeStatus") != 1,
        any_of(
            F.col("lvl").isin("organic", "jobalert"),
            (F.col("lvl") == "sponsored") & (F.col("sv") == "spon_active"),
        ),
    )
    got = sorted((r.dupeStatus, r.lvl, r.sv) for r in df.where(cond).collect())
    assert got == [(0, "jobalert", None), (0, "organic", None), (0, "sponsored", "spon_active")]


def test_empty_signal_and_guard(spark):
    a, b = keys(spark, [1, 2]), keys(spark, [3])
    empty = keys(spark, []).where(F.lit(False))
    assert col_values(in_any([a, empty, b], "k"), "k") == [1, 2, 3]
    with pytest.raises(EmptyAudienceError):
        require_rows(empty, "signal")
    assert require_rows(a) is a


def test_codes(spark):
    df = spark.createDataFrame([(" fr ",), ("FR",), ("fra",), ("f1",), (None,)], "lang string")
    assert sorted(r.lang for r in df.where(two_letter_code("lang")).collect()) == [" fr ", "FR"]
    # both read a padded code as the code
    assert [r.lang for r in df.where(same_code("lang", " Fr ", "lower")).collect()] == [" fr ", "FR"]
    assert [r.lang for r in df.where(same_code("lang", "fr", "upper")).collect()] == [" fr ", "FR"]
    assert check_code("country", " br ") == "br"
    with pytest.raises(ValueError):
        check_code("country", "BRA")


def test_rename_missing_column_fails(spark):
    with pytest.raises(ValueError):
        rename(keys(spark, [1]), {"nope": "x"})


def test_in_all_and_audience(spark):
    a = keys(spark, [1, 1, 2, 3, None])
    b = keys(spark, [2, 3, 3, 4])
    assert col_values(audience(a, "k"), "k") == [1, 2, 3]
    assert col_values(in_all([a, b], "k"), "k") == [2, 3]


def test_multivalued_predicates_on_missing_lists(spark):
    from reachset.functions.predicates import any_value_in, none_value_is

    df = spark.createDataFrame(
        [(1, ["a", "privileged"]), (2, ["a"]), (3, []), (4, None)], "k int, g array<string>"
    )
    assert sorted(r.k for r in df.where(none_value_is("g", "privileged")).collect()) == [2, 3, 4]
    assert sorted(r.k for r in df.where(any_value_in("g", ["a", "z"])).collect()) == [1, 2]


def test_signal_flags_single_pass(spark):
    from reachset.operators.algebra import signal_flags

    df = spark.createDataFrame(
        [(1, "view", 5.0), (1, "click", None), (2, "view", 1.0), (3, "buy", 9.0), (None, "view", 1.0)],
        "u bigint, t string, v double",
    )
    flags = signal_flags(df, "u", {"viewed": F.col("t") == "view", "big": F.col("v") > 4})
    got = sorted(tuple(r) for r in flags.collect())
    assert got == [(1, True, True), (2, True, False), (3, False, True)]
    both = flags.where(F.col("viewed") & ~F.col("big")).select("u")
    assert [r.u for r in both.collect()] == [2]


def test_one_rule_for_not_equal(spark):
    df = spark.createDataFrame(
        [(1, "a", ["a", "b"]), (2, "b", ["c"]), (3, None, None), (4, "", [])],
        "i int, s string, m array<string>",
    )
    kept = lambda cond: sorted(r.i for r in df.where(cond).collect())
    assert kept(not_equal("s", "a")) == [2, 3, 4]
    assert kept(not_equal("s", "a", "b")) == [3, 4]
    assert kept(none_value_is("m", "a")) == [2, 3, 4]
    assert kept(none_value_is("s", "a", scalar=True)) == [2, 3, 4]
    assert kept(any_value_in("s", ["a", "b"], scalar=True)) == [1, 2]
    assert kept(any_value_in("m", ["a", "c"])) == [1, 2]
    assert kept(non_empty("s")) == [1, 2]
    assert is_multivalued(df, "m") and not is_multivalued(df, "s")


def test_place_filters(spark):
    presets = {
        ("X", True): MarketPreset("X", True, "M", "S", None, ("A", "B")),
        ("X", False): MarketPreset("X", False, "M", "S", "c1", ("A",)),
    }
    df = spark.createDataFrame(
        [(1, "c1", "A"), (2, "c2", "B"), (3, "c3", "A"), (4, None, "A"), (5, "c1", None)],
        "i int, city string, region string",
    )
    cities = spark.createDataFrame([("c1",), ("c2",), ("c2",), (None,)], "name string")
    ids = lambda out: sorted(r.i for r in out.collect())
    assert ids(near_market(df, presets, "X", False, "city", "region")) == [1]
    assert ids(near_market(df, presets, "X", False, "city")) == [1, 5]
    metro = near_market(
        df, presets, "X", True, "city", "region", metro_cities=cities, metro_key="name", spread_by="i"
    )
    assert ids(metro) == [1, 2]
    with pytest.raises(ValueError, match="cities"):
        near_market(df, presets, "X", True, "city")
