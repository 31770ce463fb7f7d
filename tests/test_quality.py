import pytest
from pyspark.sql import functions as F

from tabloom.operators import quality as q
from tabloom.operators.relational import keep_first, mark_duplicates, same_rows, union_indexed
from tabloom.plans.report import plan_text

CONTRACT = q.Contract([q.Rule("tempo", 0, 250, nullable=True), q.Rule("genre", allowed=["pop", "jazz"])], unique=["id"])


@pytest.fixture
def df(spark):
    rows = [(1, 100.0, "pop"), (2, None, "jazz"), (3, -1.0, "pop"), (4, 9999.0, "jaz"), (5, 90.0, None), (5, 91.0, "pop")]
    return spark.createDataFrame(rows, "id int, tempo double, genre string")


def test_report_counts_every_check(df):
    got = {r["check"]: r["violations"] for r in q.contract_report(df, CONTRACT).collect()}
    assert got == {"in_range(tempo, 0, 250)": 2, "not_null(genre)": 1, "isin(genre)": 1, "unique(id)": 2}


def test_quarantine_gives_reasons(df):
    good, bad = q.quarantine(df, CONTRACT)
    assert sorted(r["id"] for r in good.collect()) == [1, 2]
    reasons = {(r["id"], r["tempo"]): set(r["reasons"]) for r in bad.collect()}
    assert reasons[(4, 9999.0)] == {"in_range(tempo, 0, 250)", "isin(genre)"}
    assert reasons[(5, 90.0)] == {"not_null(genre)", "unique(id)"}


def test_enforce(df):
    good, _ = q.quarantine(df, CONTRACT)
    assert q.enforce(good, CONTRACT).count() == 2
    with pytest.raises(q.ContractError, match="in_range"):
        q.enforce(df, CONTRACT)
    with pytest.raises(q.ContractError, match="missing column"):
        q.enforce(df.drop("genre"), CONTRACT)


def test_receipt(df):
    with pytest.raises(q.ContractError):
        q.receipt_check(df, 6, 3, 0, ("genre", 2))
    q.receipt_check(df, 6, 3, 2, ("id", 5))


def test_dirt_then_clean(spark):
    base = spark.range(2000).select(
        F.col("id"), (F.col("id") % 200 + 1.5).alias("tempo"),
        F.element_at(F.array(F.lit("pop"), F.lit("reggaeton")), (F.col("id") % 2 + 1).cast("int")).alias("genre"),
    )
    dirty = q.inject_defects(base, "id", "tempo", "genre", ("reggaeton", "regeton")).cache()
    assert dirty.count() == 2025
    assert dirty.where("tempo like '%,%'").count() == 30
    assert dirty.where("tempo = '-1.0'").count() == 15
    assert dirty.where("tempo = '9999.0'").count() == 10
    assert dirty.where("genre = 'regeton'").count() == 20
    report = q.type_repair_report(dirty, "tempo").first()
    assert report["non_numeric"] == 30 and 20 < report["missing_after"] < 70
    cleaned = q.clean(
        q.repair_numbers(dirty, "tempo"), ["id"], ["copy"], {"genre": {"regeton": "reggaeton"}}, "tempo", 0, 250, 9999
    )
    assert cleaned.count() == 2000 - 25
    contract = q.Contract([q.Rule("tempo", 0, 250, nullable=True), q.Rule("genre", allowed=["pop", "reggaeton"])], unique=["id"])
    assert q.contract_report(cleaned, contract).where("violations > 0").isEmpty()


def test_defects_do_not_depend_on_partitions(spark):
    base = spark.range(500).select("id", (F.col("id") + 0.5).alias("v"), F.lit("a").alias("g"))
    one = q.inject_defects(base.repartition(1), "id", "v", "g", ("a", "b"))
    many = q.inject_defects(base.repartition(17), "id", "v", "g", ("a", "b"))
    assert same_rows(one, many)


def test_first_row_per_key_is_limited_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, 3), (1, 2), (2, 9)], "k int, o int")
    kept = keep_first(df, ["k"], ["o"])
    assert sorted(map(tuple, kept.collect())) == [(1, 2), (2, 9)]
    text = plan_text(kept, "simple")
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")
    marks = mark_duplicates(df, ["k"], ["o"])
    assert sorted(map(tuple, marks.collect())) == [(1, 2, False), (1, 3, True), (2, 9, False)]


def test_union_index(spark):
    a, b = spark.createDataFrame([(1, 5.0), (2, 1.0)], "k int, v double"), spark.createDataFrame([(3, 3.0)], "k int, v double")
    assert sorted((r["k"], r["row_index"]) for r in union_indexed([a, b], "v", "k").collect()) == [(1, 2), (2, 0), (3, 1)]


def test_coercion_reports_what_does_not_fit(spark):
    df = spark.createDataFrame([("1", "2.5", "x"), ("a", None, "y"), ("3.7", "z", "w")], "a string, b string, c string")
    out, report = q.coerce(df, q.Contract([], types={"a": "int", "b": "double"}))
    assert {r["column_name"]: r["misfits"] for r in report.collect()} == {"a": 2, "b": 1}
    assert dict(out.dtypes) == {"a": "int", "b": "double", "c": "string"}
    with pytest.raises(q.ContractError, match="missing column"):
        q.coerce(df, q.Contract([], types={"d": "int"}))


def test_stream_contract_agrees_with_quarantine(spark):
    from tabloom.session import scratch_path
    from tabloom.streaming import runs

    rows = [(1, 5.0), (1, 6.0), (2, 999.0), (3, 1.0), (4, 2.0), (2, 3.0)]
    df = spark.createDataFrame(rows, "id int, v double")
    contract = q.Contract([q.Rule("v", 0, 100)], unique=["id"])
    path = scratch_path(spark, "stream")
    for part in (rows[:2], rows[2:4], rows[4:]):
        spark.createDataFrame(part, df.schema).coalesce(1).write.mode("append").parquet(path)
    good, bad = runs.contract_run(runs.open_stream(spark, path, df.schema, 1), contract)
    want_good, want_bad = q.quarantine(df, contract)
    assert same_rows(good, want_good) and same_rows(bad, want_bad)
    assert sorted(r["id"] for r in good.collect()) == [3, 4]


def test_observed_steps_take_one_scan(spark):
    """The report equals that of separate passes, and every input row is read once."""
    rows = [(k % 40, k, "MACHNERY" if k % 7 == 0 else "MACHINERY", None if k % 11 == 0 else float(k * 3 - 20)) for k in range(200)]
    base = spark.createDataFrame(rows, "key long, copy long, segment string, value double").repartition(4)
    contract = q.Contract([q.Rule("value", 0.0, 500.0, nullable=True), q.Rule("segment", allowed=["MACHINERY"])], unique=["key"])
    settings = (["key"], ["copy"], {"segment": {"MACHNERY": "MACHINERY"}}, "value", 0.0, 100.0, 43.0)
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            read.add(len(b))
            yield b

    source = base.mapInPandas(counted, base.schema)
    out, report = q.observed_clean(source, *settings, contract)
    assert read.value == 200
    want = q.clean(base, *settings)
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    steps = q.step_report({"typed": base, "cleaned": want}, contract, "value")
    assert sorted(map(tuple, report.collect())) == sorted(map(tuple, steps.collect()))
    empty, zeros = q.observed_clean(base.limit(0), *settings, contract)
    assert empty.count() == 0 and [tuple(r)[2:] for r in zeros.collect()] == [(0, 0, 0)] * 2
    with pytest.raises(ValueError):
        q.observed_clean(base, *settings, q.Contract([], unique=["copy"]))
