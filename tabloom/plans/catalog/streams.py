"""Streaming forms, run over the whole tables with availableNow and compared with batch results."""

from pyspark.sql import functions as F

from ...operators.quality import Contract, Rule
from ...session import scratch_path
from ...sources import tables
from ...streaming import runs, state
from ..registry import Tables, query


BATCHES = 8
LATENESS = "4 days"  # rows come up to two days late, so none is lost, and state older than this goes


def event_files(t: Tables, twice: bool = False, close: bool = False) -> str:
    """The events as they arrive, up to two days after they happened, in groups of two days.

    With `twice`, one in ten is delivered a second time a day later, and groups hold one day. With `close`, a mark
    of user -1 follows long after the last one, which lets the watermark pass all events. Groups are written one
    after the other, because a file stream reads files in the order of their times. A group's days and the delay
    stay within the lateness, so no row is late however the files of a group fall into batches.
    """
    path, sorted_in = scratch_path(t.spark, "event-files"), scratch_path(t.spark, "event-groups")
    delay = F.pmod(F.xxhash64("event_id"), F.lit(3))
    events = t.events.withColumn("__delay", delay)
    if twice:
        again = events.where(F.pmod(F.xxhash64("event_id", F.lit("twice")), F.lit(10)) == 0)
        events = events.unionByName(again.withColumn("__delay", F.col("__delay") + 1))
    days = 1 if twice else 2
    first, last = t.events.agg(F.min(F.to_date("ts")), F.max(F.to_date("ts"))).first()
    arrival = F.date_diff(F.to_date("ts"), F.lit(first)) + F.col("__delay")
    # the table is dealt into its groups in one pass, and each group is read by itself
    tables.write_partitioned(events.withColumn("arrival_group", F.floor(arrival / days).cast("int")).drop("__delay"), sorted_in, "arrival_group")
    groups = t.spark.read.parquet(sorted_in)
    for group in range(((last - first).days + 3) // days + 1):
        groups.where(F.col("arrival_group") == group).drop("arrival_group").write.mode("append").parquet(path)
    if close:
        last = t.events.agg(F.max("ts").alias("ts")).withColumns({"user_id": F.lit(-1).cast("long"), "event_id": F.lit(-1).cast("long")})
        mark = last.withColumn("ts", F.col("ts") + F.expr("INTERVAL 30 DAYS"))
        t.events.limit(0).unionByName(mark, allowMissingColumns=True).coalesce(1).write.mode("append").parquet(path)
    return path


def stream(t: Tables, twice: bool = False, close: bool = False):
    """The events in about BATCHES micro-batches: larger tables have larger batches, not more of them."""
    path = event_files(t, twice, close)
    files = t.spark.read.format("binaryFile").load(path).select("length").count()
    return runs.open_stream(t.spark, path, t.events.schema, files_per_batch=-(-files // BATCHES))


@query(
    "r1_tumbling_windows",
    """SELECT date_trunc('day', ts) AS start, date_trunc('day', ts) + INTERVAL 1 DAY AS "end", count(*) AS n,
              round(avg(value), 6) AS mean FROM events GROUP BY ALL""",
)
def r1(t: Tables):
    out = runs.windowed_run(stream(t), "ts", LATENESS, "1 day", n=F.count("*"), mean=F.round(F.avg("value"), 6))
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start", "end")})


@query(
    "r1b_sliding_windows",
    """SELECT s AS start, s + INTERVAL 7 DAY AS "end", count(*) AS n, round(avg(value), 6) AS mean FROM
       (SELECT value, date_trunc('day', ts) - to_days(CAST(unnest(range(7)) AS INTEGER)) AS s FROM events) GROUP BY s""",
)
def r1b(t: Tables):
    out = runs.windowed_run(stream(t), "ts", LATENESS, "7 days", "1 day", n=F.count("*"), mean=F.round(F.avg("value"), 6))
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start", "end")})


@query(
    "r2_contract_per_micro_batch",
    """WITH k AS (SELECT value, event_type, count(*) OVER (PARTITION BY user_id, event_type, date_trunc('hour', ts)) AS n FROM events)
       SELECT (value > 60)::INTEGER + (event_type NOT IN ('click', 'view', 'error'))::INTEGER + (n > 1)::INTEGER AS reasons,
              count(*) AS n FROM k GROUP BY reasons""",
)
def r2(t: Tables):
    rules = [Rule("value", high=60), Rule("event_type", allowed=["click", "view", "error"])]
    hourly = stream(t).withColumn("hour", F.date_trunc("hour", "ts"))
    good, bad = runs.contract_run(hourly, Contract(rules, unique=["user_id", "event_type", "hour"]))
    kinds = bad.select(F.size("reasons").alias("reasons")).unionByName(good.select(F.lit(0).alias("reasons")))
    return kinds.groupBy("reasons").agg(F.count("*").alias("n"))


@query("r3_streaming_dedupe", "SELECT event_id, user_id, event_type FROM events")
def r3(t: Tables):
    """Deliveries repeat within the lateness, so each event comes out once."""
    return runs.dedupe_run(stream(t, twice=True), ["event_id"], "ts", LATENESS).select("event_id", "user_id", "event_type")


def _window_psi_sql() -> str:
    edges = ", ".join(f"quantile_cont(value, {i / 10})" for i in range(11))
    number = " + ".join(["CAST(value >= e[1] - 1e-6 AS INTEGER)"] + [f"CAST(value >= e[{i + 1}] AS INTEGER)" for i in range(1, 10)])
    return f"""WITH e AS (SELECT [{edges}] AS e FROM events WHERE event_type = 'click'),
      b AS (SELECT date_trunc('day', ts) AS d, event_type, CASE WHEN value >= e[1] - 1e-6 AND value <= e[11] + 1e-6
            THEN {number} - 1 END AS bin FROM events, e),
      base AS (SELECT bin, count(*) AS c, sum(count(*)) OVER () AS tot FROM b WHERE event_type = 'click' GROUP BY bin),
      days AS (SELECT d, count(*) AS tot FROM b GROUP BY d),
      new AS (SELECT d, bin, count(*) AS c FROM b GROUP BY d, bin)
      SELECT days.d AS start, days.d + INTERVAL 1 DAY AS "end", max(days.tot) AS n_new, round(sum((n - s) * ln(n / s)), 6) AS psi
      FROM (SELECT days.d AS d, i, greatest(coalesce(new.c, 0) / days.tot::DOUBLE, 1e-6) AS n,
              greatest(coalesce(base.c, 0) / (SELECT max(tot) FROM base)::DOUBLE, 1e-6) AS s
            FROM days, (SELECT unnest(range(10)) AS i) LEFT JOIN base ON base.bin = i LEFT JOIN new ON new.d = days.d AND new.bin = i) x
      JOIN days ON days.d = x.d GROUP BY days.d"""


@query("r4_windowed_stability_index", _window_psi_sql())
def r4(t: Tables):
    base = t.events.where(F.col("event_type") == "click")
    out = runs.drift_run(stream(t), base, "value", "ts", LATENESS, "1 day")
    out = out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start", "end")})
    return out.withColumn("psi", F.round("psi", 6))


@query(
    "r5_trailing_means_on_a_stream",
    """SELECT user_id, event_id, CASE WHEN count(*) OVER w = 5 THEN round(avg(value) OVER w, 6) END AS mean FROM events
       WHERE user_id IS NOT NULL WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)""",
)
def r5(t: Tables):
    means = state.trailing_means(stream(t, close=True), "user_id", "ts", "event_id", "value", 5, LATENESS)
    _, rows = runs.run_to_table(means, "append", "trailing")
    return rows.where("user_id >= 0").select("user_id", "event_id", F.round("mean", 6).alias("mean"))
