"""Findings, repairs and threshold sweep on planted tables."""

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import cleaning, diagnose, evaluate, planting
from ledgerlens.operators.profile import JointProfile, Profile, dataset
from ledgerlens.functions.parsing import null_default_tokens, parse_number
from ledgerlens.plans import review
from ledgerlens.plans.views import table

SF = "/root/testdata/sf0.001"
AS_OF = "2026-08-09"


@pytest.fixture(scope="module")
def planted(spark):
    """The planted table as a text reader would deliver it, with default null tokens already null."""
    df = planting.plant_defects(table(spark, "/root/testdata/sf0.01", "orders"))
    read = df.select(*[null_default_tokens(cleaning.named(c)).alias(c) for c in df.columns])
    return Profile(read, "planted", AS_OF)


def found(p):
    return {(r["rule_id"], r["column"]) for r in diagnose.diagnose(p).collect()}


def test_planted_defects_are_all_found_and_nothing_else(planted):
    assert found(planted) == {
        ("H1", None), ("H2", None), ("H3", None), ("H5", "Inspection Note"), ("H5", "Unnamed: 6"), ("H6", "Depot"),
        ("H7", "Priority"), ("H8", "Amount"), ("H8", "Tax Share"), ("H9", "Promised"), ("H10", "Fragile"), ("H12", "Priority"),
        ("H13", "Packed By"), ("H14", "Age Days"), ("H15", "Lot Ref"), ("H15", "Scan Url"), ("H16", "Crate Count"),
        ("H17", "Crate Count"), ("H17", "Age Days"), ("H19", "Crate Count"), ("H20", "Crate Count"), ("H20", "Age Days"),
        ("H21", "Promised")}


def test_clean_control_raises_only_text_dates(spark):
    p = Profile(planting.clean_control(table(spark, SF, "orders")), "control", AS_OF)
    assert found(p) == {("H9", "booked")}


def test_findings_are_ordered_by_severity_then_column(planted):
    rows = diagnose.diagnose(planted).collect()
    keys = [(r["severity_rank"], r["column"] or "", int(r["rule_id"][1:])) for r in rows]
    assert keys == sorted(keys)
    assert all(r["title"] and r["detail"] and r["impact"] and r["action"] for r in rows)


def test_starting_points(planted):
    steps = diagnose.starting_points(planted, diagnose.diagnose(planted)).collect()
    assert [(r["step"], r["rule"]) for r in steps] == list(enumerate(
        ["placeholders", "types", "spellings", "keys", "duplicates", "analyse"], 1))
    assert '"Promised", "Amount", "Tax Share", "Crate Count", "Age Days"' in steps[-1]["text"]


def test_strict_names_ask_for_whole_words(spark):
    rows = [(str(i - 3),) for i in range(40)]
    p = Profile(spark.createDataFrame(rows, "page string"), "t", AS_OF)
    assert ("H16", "page") in found(p)
    assert "H16" not in {r["rule_id"] for r in diagnose.diagnose(p, strict_names=True).collect()}


def test_repairs_silence_their_findings(planted):
    df = planted.df
    df = cleaning.drop_unnamed_columns(cleaning.drop_identical_columns(cleaning.drop_uninformative_columns(df)))
    df = cleaning.strip_whitespace(cleaning.normalise_category(cleaning.placeholders_to_null(df, ["Priority"]), ["Priority"]), ["Packed By"])
    df = cleaning.text_to_boolean(cleaning.text_to_date(df, ["Promised"]), ["Fragile"])
    df = cleaning.sentinels_to_null(df, "Crate Count", [-4, 5000])
    df = cleaning.drop_repeated_rows(cleaning.text_to_number(df, ["Amount", "Tax Share", "Crate Count", "Age Days"]))
    left = found(Profile(df, "cleaned", AS_OF, text=False))
    assert {r for r, _ in left} == {"H14", "H15", "H17", "H20", "H21"}
    assert ("H17", "Crate Count") not in left


def test_repeated_rows_are_listed_with_every_copy(spark):
    df = spark.createDataFrame([("a", None)] * 3 + [("b", "x")], "k string, v string")
    assert [tuple(r) for r in cleaning.list_repeated_rows(df).collect()] == [("a", None)] * 3


def test_rows_of_one_digest_are_told_apart(spark, monkeypatch):
    def weak(rows):
        return rows.withColumn("digest_a", F.lit(1).cast("bigint")).withColumn("digest_b", F.coalesce(F.col("c0"), F.lit("")) == "a")

    monkeypatch.setattr(dataset, "digested", weak)
    monkeypatch.setattr(cleaning, "digested", weak)
    rows = [("a", None)] * 3 + [("a", 1), ("b", 1), ("b", 1), ("c", 1), (None, 1), (None, 1), (None, None)]
    df = spark.createDataFrame(rows, "k string, v int")
    assert dataset.surplus_rows(df).first()[0] == 4
    assert sorted(map(tuple, cleaning.list_repeated_rows(df).collect()), key=str) == sorted([("a", None)] * 3 + [("b", 1)] * 2 + [(None, 1)] * 2, key=str)
    assert sorted((r[0], r[1], r["copies"]) for r in dataset.repeated_rows(df).where("k is not null").collect()) == [("a", None, 3), ("b", 1, 2)]


def test_pooling_keeps_nulls_and_the_most_frequent(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)] * 2 + [("c",), (None,)], "g string")
    got = {r[0]: r[1] for r in cleaning.pool_rare_categories(df, "g", 2).groupBy("g").count().collect()}
    assert got == {"a": 3, "b": 2, "Other": 1, None: 1}
    clash = cleaning.pool_rare_categories(df.selectExpr("g as kept", "1 as kept_0"), "kept", 2)
    assert clash.columns == ["kept", "kept_0"] and clash.where("kept = 'Other'").count() == 1


def test_sweep_loses_recall_as_the_rate_grows(spark, planted):
    orders = table(spark, "/root/testdata/sf0.01", "orders")
    both = JointProfile({"planted": planting.plant_defects(orders), "control": planting.clean_control(orders)}, AS_OF)
    rows = evaluate.sensitivity_of(both, review.truth_of(spark)).collect()
    # Side by side the tables measure as they do alone.
    alone = {r["name"]: r.asDict() for r in planted.numeric.collect()}
    joint = {r["name"]: r.asDict() for r in both.numeric.collect() if both.owners[r["position"]] == "planted"}
    assert joint == alone
    recall = [r["recall"] for r in rows]
    assert recall[:3] == [1.0, 1.0, 1.0] and recall == sorted(recall, reverse=True) and recall[-1] == 0.0
    assert all(r["false_alarms"] == 0 for r in rows) and rows[-1]["precision"] is None


def test_more_than_sixty_codes_are_all_found(spark):
    p = Profile(planting.plant_many_codes(table(spark, "/root/testdata/sf0.01", "orders")), "coded", AS_OF)
    hits = diagnose.sentinel_hits(p.numeric, p.repeated_values, [0.002]).collect()
    assert len({r["value"] for r in hits if abs(r["value"]) > 1000}) == planting.MANY_CODES
    assert p.frequent_values.where("name = 'reading'").count() == 60  # the listing alone is short


def test_a_false_alarm_lowers_precision(spark):
    hits = spark.createDataFrame([(0.002, "t", "c", 5.0, 9)], "rate double, dataset string, `column` string, value double, n bigint")
    truth = spark.createDataFrame([("t", "c", 1.0)], "dataset string, column string, value double")
    row = evaluate.sensitivity(evaluate.judged(hits, truth, [0.002]), [0.002]).first()
    assert (row["found"], row["false_alarms"], row["missed"], row["precision"], row["recall"]) == (0, 1, 1, 0.0, 0.0)
    detail = evaluate.flag_detail(evaluate.judged(hits, truth, [0.002])).first()["flags"]
    assert detail == "t:c=5.0000 (FALSE POSITIVE)"


def test_sample_values_need_no_profile(spark):
    p = Profile(planting.plant_defects(table(spark, SF, "orders")), "planted", AS_OF)
    samples = {r["name"]: r["sample_values"] for r in p.samples.collect()}
    assert not {"frequencies", "summary"} & set(p.__dict__)
    assert samples == {r["name"]: r["sample_values"] for r in p.columns.select("name", "sample_values").collect()}


def test_a_fence_needs_its_own_column_only(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(review, "Profile", lambda df, *a, **b: seen.append(p := Profile(df, *a, **b)) or p)
    rows = review.i16_outliers(spark, SF)
    whole = Profile(review.dataset(spark, SF, "planted"), "planted", AS_OF)
    assert [p.names for p in seen] == [["Crate Count"]] and "columns" not in seen[0].__dict__
    assert sorted(map(str, rows.collect())) == sorted(map(str, cleaning.outlier_rows(whole.df, "Crate Count", whole.columns).collect()))


def test_the_sweep_counts_values_only_where_numbers_may_be(spark):
    p = review.swept(spark, SF)
    assert set(p.names) == {"Promised", "Amount", "Tax Share", "Crate Count", "Age Days", "rate", "booked", "pallets"}
    whole = JointProfile({n: review.dataset(spark, SF, n) for n in ("planted", "control")}, AS_OF)
    assert sorted(map(str, evaluate.flagged(p).collect())) == sorted(map(str, evaluate.flagged(whole).collect()))


def test_every_start_of_a_number_is_taken_for_one(spark):
    starts = ["1", " 2", "\t　-3", "(4)", "€ 5", "+.5", "inf", " -Infinity", "%1", "1,000.5", "$(6)", "\x857", "-\n¥8", "n/a", ""]
    df = spark.createDataFrame([(v, "x" + v, None) for v in starts], "a string, b string, c string")
    assert evaluate.maybe_numeric(df).columns == ["a"]
    assert evaluate.maybe_numeric(df.select("b", "c")).columns == ["b", "c"]
    parsed = df.select(parse_number(F.col("a")).alias("x")).where("x is not null").count()
    assert parsed == len(starts) - 2
