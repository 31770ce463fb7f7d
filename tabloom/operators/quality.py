"""Data contracts, repair, cleaning, and a defect maker to test cleaners with."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..functions.hashing import digest, uniform
from ..functions.scalars import band, decimal_comma, missing_or, parse_number, recode
from ..session import written
from .joins import attach_group_stats
from .relational import keep_first


class ContractError(ValueError):
    """Rows break the contract."""


@dataclass(frozen=True)
class Rule:
    """What a column's values must satisfy. A missing value breaks it unless nullable."""

    column: str
    low: float | None = None
    high: float | None = None
    allowed: Sequence | None = None
    nullable: bool = False

    def checks(self) -> dict[str, Column]:
        """Check name -> Column that is true on a row breaking it."""
        c, out = F.col(self.column), {}
        if not self.nullable:
            out[f"not_null({self.column})"] = c.isNull()
        if self.low is not None or self.high is not None:
            bad = F.lit(False)
            if self.low is not None:
                bad = bad | (c < F.lit(self.low))
            if self.high is not None:
                bad = bad | (c > F.lit(self.high))
            out[f"in_range({self.column}, {self.low}, {self.high})"] = F.coalesce(bad, F.lit(False))
        if self.allowed is not None:
            out[f"isin({self.column})"] = F.coalesce(~c.isin(list(self.allowed)), F.lit(False))
        return out


@dataclass(frozen=True)
class Contract:
    """Column rules, expected types and a key that must not repeat."""

    rules: Sequence[Rule]
    types: Mapping[str, str] = field(default_factory=dict)
    unique: Sequence[str] = ()

    def checks(self) -> dict[str, Column]:
        return {name: bad for rule in self.rules for name, bad in rule.checks().items()}

    @property
    def key_check(self) -> str:
        return f"unique({', '.join(self.unique)})"

    def check_schema(self, df: DataFrame) -> None:
        """Column presence and types, from the schema alone."""
        problems = [f"missing column {r.column}" for r in self.rules if r.column not in df.columns]
        for name, kind in self.types.items():
            found = df.schema[name].dataType.simpleString() if name in df.columns else "nothing"
            if found != kind:
                problems.append(f"{name} is {found}, expected {kind}")
        if problems:
            raise ContractError("; ".join(problems))


def contract_report(df: DataFrame, contract: Contract) -> DataFrame:
    """Violations per check, all checks counted (check, violations).

    Row checks take one pass; rows sharing a key are counted from group sizes.
    """
    contract.check_schema(df)
    checks = contract.checks()
    counted = df.agg(*[F.count_if(bad).alias(f"c{i}") for i, bad in enumerate(checks.values())])
    pairs = [
        F.struct(F.lit(name).alias("check"), F.col(f"c{i}").alias("violations"))
        for i, name in enumerate(checks)
    ]
    report = counted.select(F.inline(F.array(*pairs)))
    if contract.unique:
        sizes = df.groupBy(*contract.unique).agg(F.count("*").alias("n"))
        repeated = F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0))
        report = report.unionByName(
            sizes.agg(F.lit(contract.key_check).alias("check"), repeated.alias("violations"))
        )
    return report


def enforce(df: DataFrame, contract: Contract) -> DataFrame:
    """The same table, or an error naming every broken check with its count."""
    broken = contract_report(df, contract).where("violations > 0").collect()  # one row per check
    if broken:
        raise ContractError("; ".join(f"{r['check']}: {r['violations']}" for r in broken))
    return df


def with_reasons(df: DataFrame, contract: Contract) -> DataFrame:
    """Each row with the array of row checks it breaks."""
    named = [F.when(bad, F.lit(name)) for name, bad in contract.checks().items()]
    return df.withColumn("reasons", F.array_compact(F.array(*named)))


def split_marked(marked: DataFrame, contract: Contract) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with their reasons) of rows marked with the checks they break;
    a key that repeats anywhere in the table is a reason too."""
    if contract.unique:
        sizes = marked.groupBy(*contract.unique).agg(F.count("*").alias("__n"))
        marked = attach_group_stats(marked, contract.unique, sizes)
        repeated = F.when(F.col("__n") > 1, F.array(F.lit(contract.key_check)))
        none = F.array().cast("array<string>")
        marked = marked.withColumn("reasons", F.concat("reasons", F.coalesce(repeated, none))).drop("__n")
    ok = F.size("reasons") == 0
    return marked.where(ok).drop("reasons"), marked.where(~ok)


def quarantine(df: DataFrame, contract: Contract) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with their reasons); repeated keys are a reason too."""
    return split_marked(with_reasons(df, contract), contract)


def coerce(df: DataFrame, contract: Contract) -> tuple[DataFrame, DataFrame]:
    """Cast the contract's typed columns: (table, report of (column_name, misfits)).

    A misfit is a value that its type can't hold; it becomes missing, so a column that isn't
    nullable then breaks the contract.
    """
    missing = [c for c in contract.types if c not in df.columns]
    if missing:
        raise ContractError("; ".join(f"missing column {c}" for c in missing))
    if not contract.types:
        return df, df.sparkSession.createDataFrame([], "column_name string, misfits long")
    cast = {c: F.col(c).try_cast(kind) for c, kind in contract.types.items()}
    lost = df.agg(*[F.count_if(F.col(c).isNotNull() & new.isNull()).alias(c) for c, new in cast.items()])
    report = lost.unpivot([], list(cast), "column_name", "misfits")
    return df.withColumns(cast), report


def receipt_check(df: DataFrame, rows: int, columns: int, nulls: int, distinct: tuple[str, int]) -> DataFrame:
    """Shape, missing values and distinct count against what was promised; raises with the values."""
    if len(df.columns) != columns:
        raise ContractError(f"{len(df.columns)} columns, expected {columns}")
    key, expected = distinct
    missing = [F.count_if(F.col(c).isNull()) for c in df.columns]
    facts = df.agg(
        F.count("*").alias("rows"),
        sum(missing[1:], missing[0]).alias("nulls"),
        F.count_distinct(key).alias("distinct_values"),
    )
    found = facts.first()
    wanted = (rows, nulls, expected)
    if tuple(found) != wanted:
        raise ContractError(f"(rows, nulls, distinct {key}) = {tuple(found)}, expected {wanted}")
    return facts


def repair_numbers(df: DataFrame, column: str) -> DataFrame:
    """Text column to double, decimal commas repaired."""
    return df.withColumn(column, decimal_comma(column))


def type_repair_report(df: DataFrame, column: str) -> DataFrame:
    """Texts that aren't numbers as they stand, and those still missing after the repair."""
    plain, repaired = parse_number(column), decimal_comma(column)
    return df.agg(
        F.count("*").alias("rows"),
        F.count_if(plain.isNull() & F.col(column).isNotNull()).alias("non_numeric"),
        F.count_if(repaired.isNull()).alias("missing_after"),
    )


def clean(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    recodes: Mapping[str, Mapping],
    value: str,
    low: float,
    high: float,
    sentinel: float,
) -> DataFrame:
    """Repair labels, keep one row per key, drop only impossible values; missing values stay."""

    def possible(d: DataFrame) -> DataFrame:
        return d.where(missing_or(value, F.col(value).between(low, high) & (F.col(value) != sentinel)))

    repaired = df.withColumns({c: recode(c, m) for c, m in recodes.items()})
    return repaired.transform(keep_first, keys, order).transform(possible)


def step_report(steps: Mapping[str, DataFrame], contract: Contract, value: str) -> DataFrame:
    """(step, rows, missing, violations) for each stage of a cleaning run."""
    out = None
    for i, (name, df) in enumerate(steps.items()):
        facts = df.agg(F.count("*").alias("rows"), F.count_if(F.col(value).isNull()).alias("missing"))
        broken = contract_report(df, contract).agg(F.sum("violations").alias("violations"))
        row = facts.select(
            F.lit(i).alias("step_no"), F.lit(name).alias("step"), "rows", "missing",
            broken.scalar().alias("violations"),
        )
        out = row if out is None else out.unionByName(row)
    return out


def observed_clean(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    recodes: Mapping[str, Mapping],
    value: str,
    low: float,
    high: float,
    sentinel: float,
    contract: Contract,
) -> tuple[DataFrame, DataFrame]:
    """`clean`, written, and its step report (as `step_report` of "typed" and "cleaned") from the same single scan.

    Rows, missing values and broken checks are observed while rows pass on their way to the written
    table. One aggregate keeps the first row of each key and counts the key's rows. A stage that
    runs again after a lost executor observes its rows again; the counts from before the shuffle are
    therefore compared with the key sizes, and taken by a pass of their own if they don't agree.
    """
    if set(contract.unique) - set(keys) or (contract.unique and set(contract.unique) != set(keys)):
        raise ValueError("the contract's key must be the key that is cleaned by")
    contract.check_schema(df)

    def facts() -> list[Column]:
        broken = [F.count_if(bad) for bad in contract.checks().values()]
        return [
            F.count(F.lit(1)).alias("rows"),
            F.count_if(F.col(value).isNull()).alias("missing"),
            sum(broken, F.lit(0)).cast("long").alias("violations"),
        ]

    typed, sizes, cleaned = (Observation(f"{name}-{uuid.uuid4().hex}") for name in ("typed", "sizes", "cleaned"))
    repaired = df.observe(typed, *facts()).withColumns({c: recode(c, m) for c, m in recodes.items()})
    row, place = F.struct(*df.columns), F.struct(*order)
    first = repaired.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), F.min_by(row, place).alias("__row"))
    several = F.coalesce(F.sum(F.when(F.col("__n") > 1, F.col("__n"))), F.lit(0))
    first = first.observe(sizes, F.coalesce(F.sum("__n"), F.lit(0)).alias("rows"), several.alias("repeated"))
    possible = missing_or(value, F.col(value).between(low, high) & (F.col(value) != sentinel))
    kept = first.select("__row.*").where(possible).select(*df.columns).observe(cleaned, *facts())
    out = written(kept, "cleaned")
    before, after, found = typed.get, cleaned.get, sizes.get
    if before["rows"] != found["rows"]:
        before = df.agg(*facts()).first().asDict()
    repeated = found["repeated"] if contract.unique else 0
    rows = [
        (0, "typed", before["rows"], before["missing"], before["violations"] + repeated),
        (1, "cleaned", after["rows"], after["missing"], after["violations"]),
    ]
    schema = "step_no int, step string, rows long, missing long, violations long"
    return out, df.sparkSession.createDataFrame(rows, schema)


# How many rows get each defect.
DEFECTS = {"comma": 30, "negative": 15, "sentinel": 10, "duplicate": 25, "typo": 20}


def inject_defects(
    df: DataFrame,
    key: str,
    value: str,
    label: str,
    typo: tuple[str, str],
    salt: str = "42",
    missing_share: float = 0.02,
) -> DataFrame:
    """Spoil disjoint rows in known ways; the value column becomes text.

    About 2 % of the values go missing; then, in hash order of the rows that still have
    one, the first 30 get a decimal comma, 15 an impossible value, 10 a sentinel, 25 are
    repeated, and 20 of the others with the label get a misspelt one. `key` names a row.
    """
    start = df.withColumn(value, F.when(uniform(key, salt + "-gap") >= missing_share, F.col(value)))
    order = digest(key, salt)
    known = start.where(F.col(value).isNotNull()).withColumn("__h", order)
    edges, upto = {}, 0
    for name in ("comma", "negative", "sentinel", "duplicate"):
        edges[name] = (upto, upto + DEFECTS[name])
        upto += DEFECTS[name]
    # 'upto' marked rows, then 20 typos: a fixed number of rows whatever the table size
    first = known.select(key, "__h").orderBy("__h").limit(upto)
    first = first.withColumn("__r", F.row_number().over(Window.partitionBy().orderBy("__h")) - 1)
    defect = F.lit(None).cast("string")
    for name, (lo, hi) in edges.items():
        defect = F.when((F.col("__r") >= lo) & (F.col("__r") < hi), name).otherwise(defect)
    first = first.select(key, "__h", defect.alias("__defect"))
    last = first.agg(F.max("__h")).scalar()
    typos = known.where((F.col(label) == typo[0]) & (F.col("__h") > last)).select(key, "__h")
    typos = typos.orderBy("__h").limit(DEFECTS["typo"]).select(key, "__h", F.lit("typo").alias("__defect"))
    marks = first.unionByName(typos).drop("__h")
    marked = start.join(F.broadcast(marks), key, "left")
    text = F.col(value).cast("string")
    kind = F.col("__defect")
    spoilt = marked.withColumn(
        value,
        F.when(kind == "comma", F.translate(text, ".", ","))
        .when(kind == "negative", "-1.0")
        .when(kind == "sentinel", "9999.0")
        .otherwise(text),
    ).withColumn(label, F.when(kind == "typo", typo[1]).otherwise(F.col(label)))
    copies = F.when(kind == "duplicate", F.sequence(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return spoilt.withColumn("copy", F.explode(copies)).select(*df.columns, "copy")


def enrich(df: DataFrame, value: str, edges: Sequence[float], labels: Sequence[str], level: str, cut: float) -> DataFrame:
    """Add a labelled band of one column and a high/low flag of another."""
    return df.withColumn("band", band(value, edges, labels)).withColumn("is_high", F.col(level) >= cut)
