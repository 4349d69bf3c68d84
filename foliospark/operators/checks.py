"""Contract checks: one uniform result row per rule.

All row rules share one scan and one shuffle.  Every row emits a few small
facts ``(rule, kind, value)``, never its text; the facts are counted per value
(map-side first), and each rule's verdict is read off the counts.  A key that
occurs in a third of all rows is one pre-aggregated count per task.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import date

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window, functions as F

from foliospark import constants as K
from foliospark.contract import Contract
from foliospark.functions.dates import iso_date

BAD, INFO = "bad", "info"
RESULT_COLUMNS = ["check_name", "severity", "status", "message", "violations", "samples"]
RESULT_SCHEMA = ("check_name string, severity string, status string, message string, violations bigint, "
                 "samples array<string>")
#: Values a distribution's message names; ``profile.source_distribution`` has all of them as rows.
MAX_LISTED = 50


@dataclass(frozen=True)
class Rule:
    """A row rule.

    ``bad`` lists (condition, sample value) pairs of violations and ``info``
    the same for facts that only feed the message.  ``repeated`` counts only
    values occurring more than once (uniqueness).  ``per_value`` counts
    distinct values instead of rows.  ``message`` builds the text from the
    violation count ``n`` and a function giving counts of ``info`` values.
    """

    name: str
    severity: str
    ok: Callable[[Column], Column] | str
    failed: Callable[[Column], Column]
    bad: list[tuple[Column, Column]] = field(default_factory=list)
    info: list[tuple[Column, Column]] = field(default_factory=list)
    repeated: bool = False
    per_value: bool = False
    samples: bool = True
    numeric: bool = False


def _text(c: Column) -> Column:
    return c.cast("string")


def _cat(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else _text(p) for p in parts])


def _thousands(c: Column) -> Column:
    return F.format_number(c, 0)


# --- the rules -------------------------------------------------------------

def unique_rule(keys: list[str], name: str = "ra_id_unique", label: str | None = None) -> Rule:
    label = label or ", ".join(keys)
    # Several keys count as one JSON value, and a null key as a text no key has (what
    # stands before the zero character is not shown): nulls, empty texts and separators stay apart.
    one = F.coalesce(_text(F.col(keys[0])), F.lit("null key\u0000null"))
    value = F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}) if len(keys) > 1 else one
    return Rule(name, "error", f"{label} is unique",
                lambda n: _cat(n, f" duplicate {label} row(s)"),
                bad=[(F.lit(True), value)], repeated=True)


def required_rule(columns: list[str], present: list[str]) -> Rule:
    bad = [(F.col(c).isNull(), F.lit(c)) for c in columns if c in present]
    bad += [(F.lit(True), F.lit(f"{c}: column missing")) for c in columns if c not in present]
    return Rule("required_non_null", "error", "All required fields non-null",
                lambda n: _cat(n, " column(s) have nulls"), bad=bad, per_value=True)


def year_rule(low: int, high: int, column: str = "ra_year") -> Rule:
    c = F.col(column)
    return Rule("year_range", "error", f"All {column} values in [{low}, {high}]",
                lambda n: _cat(n, f" {column} value(s) out of range"),
                bad=[((c < low) | (c > high), _text(c))], numeric=True)


def stub_rule(min_length: int, min_words: int, key: str = "ra_id") -> Rule:
    short = (F.col("content_length") < min_length) | (F.col("word_count") < min_words)
    return Rule("content_non_stub", "error", "All rows have non-empty content",
                lambda n: _cat(n, f" stub row(s) (content_length<{min_length} or "
                                  f"word_count<{min_words})"),
                bad=[(short, _text(F.col(key)))], per_value=True)


def non_empty_rule(column: str = "content_normalized", key: str = "ra_id") -> Rule:
    return Rule(f"{column}_non_empty", "error", f"All {column} values non-empty",
                lambda n: _cat(n, f" row(s) have empty {column}"),
                bad=[(F.coalesce(F.length(column), F.lit(0)) == 0, _text(F.col(key)))])


def pattern_rule(pattern: str, column: str = "ra_number") -> Rule:
    wrong = ~F.coalesce(F.col(column).rlike(_anchored(pattern)), F.lit(False))
    return Rule(f"{column}_shape", "error", f"All {column} values match '{pattern}'",
                lambda n: _cat(n, f" {column} value(s) do not match expected shape"),
                bad=[(wrong, F.coalesce(_text(F.col(column)), F.lit("null")))])


def _anchored(pattern: str) -> str:
    return pattern if pattern.startswith("^") else f"^(?:{pattern})"


def date_rule(column: str = "approval_date") -> Rule:
    c = F.col(column)
    return Rule(f"{column}_valid", "error",
                lambda non_null: _cat("All ", non_null, f" non-null {column} values are valid ISO dates"),
                lambda n: _cat(n, f" {column} value(s) invalid"),
                bad=[(c.isNotNull() & ~c.rlike(K.ISO_DATE), _cat("non-ISO: ", c)),
                     (c.isNotNull() & iso_date(c).isNull(), _cat("unparseable: ", c))],
                info=[(c.isNotNull(), F.lit("non_null"))])


def source_rule(column: str = "source") -> Rule:
    return Rule("source_distribution", "warn", "", lambda n: F.lit(""),
                info=[(F.col(column).isNotNull(), F.col(column))])


def oversized_rule(limit: int, key: str = "ra_id", length: str = "content_length") -> Rule:
    big = F.col(length)
    # The leading pad makes text order equal to length order, longest first.
    rank = F.lpad((F.lit(10 ** 15) - big).cast("string"), 16, "0")
    return Rule("oversized_content", "warn", f"No rows exceed {limit:,} chars",
                lambda n: _cat(n, f" row(s) exceed {limit:,} chars"),
                bad=[(big > limit, _cat(rank, "\u0000", F.col(key), " (", _thousands(big), " chars)"))])


def allowed_rule(values: list[str], column: str = "source") -> Rule:
    return Rule(f"{column}_allowed", "error", f"All {column} values allowed",
                lambda n: _cat(n, f" {column} value(s) not allowed"),
                bad=[(~F.col(column).isin(values), F.col(column))])


def constraint_rule(name: str, predicate: Column, key: Column) -> Rule:
    """A table constraint; like SQL CHECK it passes when the result is null."""
    return Rule(name, "error", "constraint holds", lambda n: _cat(n, " row(s) violate it"),
                bad=[(~predicate, _text(key))])


def table_constraints(key: str = "ra_id") -> list[Rule]:
    """The seven constraints of the load table."""
    k = F.col(key)
    return [
        constraint_rule("ra_year_range", F.col("ra_year").between(1946, 2100), k),
        constraint_rule("ra_id_shape", F.col("ra_id").rlike("^RA-[0-9]+[A-Z]?$"), k),
        constraint_rule("ra_number_shape", F.col("ra_number").rlike("^[0-9]+[a-z]?$"), k),
        constraint_rule("source_allowed", F.col("source").isin(list(K.ALLOWED_SOURCES)), k),
        constraint_rule("word_count_nonneg", F.col("word_count") >= 0, k),
        constraint_rule("content_length_nonneg", F.col("content_length") >= 0, k),
        constraint_rule("source_path_nonempty", F.length("source_path") > 0, k),
    ]


def contract_rules(contract: Contract, columns: list[str], today: date | None = None) -> list[Rule]:
    """The row rules of the contract, in its order."""
    low, high = contract.years(today)
    params = {name: rule.params for name, rule in contract.rules.items()}
    stub = params["content_non_stub"]
    return [
        unique_rule([contract.key]),
        required_rule(contract.required(), columns),
        year_rule(low, high),
        stub_rule(stub["min_content_length"], stub["min_word_count"]),
        non_empty_rule(),
        pattern_rule(params["ra_number_shape"]["pattern"]),
        date_rule(),
        source_rule(),
        oversized_rule(params["oversized_content"]["absolute_chars"]),
    ]


# --- running them ----------------------------------------------------------

def tally(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """``rule, kind, value, n``: the facts of all rules, counted once."""
    facts = [
        F.when(condition, F.struct(F.lit(at).alias("rule"), F.lit(kind).alias("kind"),
                                   value.alias("value")))
        for at, rule in enumerate(rules)
        for kind, group in ((BAD, rule.bad), (INFO, rule.info))
        for condition, value in group
    ]
    rows = df.select(F.explode(F.array_compact(F.array(*facts))).alias("f"))
    return rows.groupBy("f.rule", "f.kind", "f.value").agg(F.count(F.lit(1)).alias("n"))


def run_rules(df: DataFrame, rules: list[Rule], sample_n: int = K.SAMPLE_N,
              max_listed: int = MAX_LISTED) -> DataFrame:
    """One result row per rule, violations counted over all rows.

    The message of a distribution names its ``max_listed`` most frequent values
    and says how many it leaves out, so no row grows with the data.
    """
    counted = tally(df, rules)
    repeated = [at for at, r in enumerate(rules) if r.repeated]
    if repeated:
        counted = counted.where(~F.col("rule").isin(repeated) | (F.col("n") > 1))
    per_value = [at for at, r in enumerate(rules) if r.per_value]
    numeric = [at for at, r in enumerate(rules) if r.numeric]
    weight = F.when(F.col("rule").isin(per_value), F.lit(1)).otherwise(F.col("n"))

    bad, info = F.col("kind") == BAD, F.col("kind") == INFO
    totals = counted.groupBy("rule").agg(
        F.coalesce(F.sum(F.when(bad, weight)), F.lit(0)).alias("violations"),
        F.coalesce(F.sum(F.when(info, F.col("n"))), F.lit(0)).alias("info_n"),
        F.count_if(info).alias("info_values"),
    )
    as_number = F.col("value").try_cast("double")
    number = F.when(F.col("rule").isin(numeric), as_number) if numeric else F.lit(None)
    common = F.when(info, -F.col("n"))
    order = Window.partitionBy("rule", "kind").orderBy(number.cast("double"), common, "value")
    # Ranking with a limit is cut per task before the shuffle, so this stays
    # cheap however many values violate a rule.  The filter looks at the count
    # as well, which keeps it above the counting: totals and samples then share
    # one scan and one exchange.
    listed = info & F.col("rule").isin(_listed(rules))
    most = F.when(listed, max_listed).otherwise(sample_n)
    top = (
        counted.where(F.when(F.col("n") > 0, bad | listed))
        .withColumn("at", F.row_number().over(order).cast("long"))
        .where((F.col("at") <= max(sample_n, max_listed)) & (F.col("at") <= most))
    )
    top = (
        top.groupBy("rule")
        .agg(F.array_sort(F.collect_list(F.struct("kind", "at", "value", "n"))).alias("top"))
    )
    spark = df.sparkSession
    names = spark.createDataFrame(
        [(at, r.name, r.severity) for at, r in enumerate(rules)],
        "rule int, check_name string, severity string",
    )
    joined = F.broadcast(names).join(totals, "rule", "left").join(top, "rule", "left")
    return _verdicts(joined, rules, sample_n)


def _listed(rules: list[Rule]) -> list[int]:
    return [at for at, r in enumerate(rules) if isinstance(r.ok, str) and not r.bad]


def _verdicts(joined: DataFrame, rules: list[Rule], sample_n: int) -> DataFrame:
    n = F.coalesce("violations", F.lit(0))
    top = F.coalesce("top", F.array().cast("array<struct<kind:string,at:bigint,value:string,n:bigint>>"))
    bad = F.filter(top, lambda e: (e.kind == BAD) & (e["at"] <= sample_n))
    samples = F.transform(bad, lambda e: F.substring_index(e.value, "\u0000", -1))
    message, status = F.lit(None).cast("string"), F.lit(None).cast("string")
    for at, rule in enumerate(rules):
        mine = F.col("rule") == at
        if rule.name == "required_non_null":
            shown = F.transform(bad, lambda e: F.when(
                e.value.endswith("column missing"), e.value
            ).otherwise(F.concat(e.value, F.lit(": "), e.n.cast("string"), F.lit(" null(s)"))))
            samples = F.when(mine, shown).otherwise(samples)
        if not rule.bad:
            pairs = F.transform(
                F.filter(top, lambda e: e.kind == INFO),
                lambda e: F.concat(F.lit("'"), e.value, F.lit("': "), e.n.cast("string")),
            )
            values = F.coalesce("info_values", F.lit(0))
            more = F.when(values > F.size(pairs), _cat(", and ", values - F.size(pairs), " more")).otherwise("")
            text = F.concat(F.lit("source distribution: {"), F.array_join(pairs, ", "), more, F.lit("}"))
            state = F.when(values > 1, "warn").otherwise("pass")
        else:
            ok = F.lit(rule.ok) if isinstance(rule.ok, str) else rule.ok(F.coalesce("info_n", F.lit(0)))
            text = F.when(n == 0, ok).otherwise(rule.failed(n))
            state = F.when(n == 0, "pass").otherwise("warn" if rule.severity == "warn" else "fail")
        message = F.when(mine, text).otherwise(message)
        status = F.when(mine, state).otherwise(status)
    return joined.select(
        "check_name", "severity", status.alias("status"), message.alias("message"),
        n.cast("long").alias("violations"), samples.alias("samples"),
    )


# --- schema, bands, rates --------------------------------------------------

def _result(df: DataFrame, name: str, bad: Column | bool, ok: str, failed: str | Column,
            violations: Column | int, samples: Column | list[str], severity: str = "error") -> DataFrame:
    bad = F.lit(bad) if isinstance(bad, bool) else bad
    array = samples if isinstance(samples, Column) else F.array(*map(F.lit, samples)).cast("array<string>")
    return df.select(
        F.lit(name).alias("check_name"), F.lit(severity).alias("severity"),
        F.when(bad, "warn" if severity == "warn" else "fail").otherwise("pass").alias("status"),
        F.when(bad, failed).otherwise(F.lit(ok)).alias("message"),
        (F.lit(violations) if isinstance(violations, int) else violations).cast("long").alias("violations"),
        array.alias("samples"),
    )


def schema_problems(df: DataFrame, contract: Contract) -> list[str]:
    """Missing, unexpected and wrongly typed columns, from the schema alone."""
    told: dict[str, list[str]] = {"missing": [], "unexpected": [], "type": []}
    found = {f.name: f.dataType for f in df.schema}
    for name in dict.fromkeys([*contract.columns, *found]):
        if name not in found:
            told["missing"].append(f"missing column: {name}")
        elif name not in contract.columns:
            told["unexpected"].append(f"unexpected column: {name}")
        elif (wanted := contract.columns[name].kind) != found[name]:
            told["type"].append(f"{name}: expected {wanted.simpleString()}, got {found[name].simpleString()}")
    return [text for texts in told.values() for text in texts]


def check_schema(df: DataFrame, contract: Contract, sample_n: int = K.SAMPLE_N) -> DataFrame:
    """The schema is known without reading a row, so none is read."""
    problems = schema_problems(df, contract)
    return _result(df.sparkSession.range(1), "schema_conformance", bool(problems),
                   "All expected columns present with expected types",
                   f"{len(problems)} schema problem(s)", len(problems), problems[:sample_n])


def schema_report(df: DataFrame, contract: Contract) -> DataFrame:
    """One row per column of the contract or the table: ``name, expected, found, problem, non_null``.

    ``problem`` is missing, unexpected, type or null; ``non_null`` counts the
    rows with a value, 0 for a missing column.  One scan counts all columns.
    """
    found = {f.name: f.dataType.simpleString() for f in df.schema}
    wanted = {name: column.kind.simpleString() for name, column in contract.columns.items()}
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in found]) if found else df.sparkSession.range(1)
    rows = []
    for name in dict.fromkeys([*wanted, *found]):
        told = ("missing" if name not in found else "unexpected" if name not in wanted
                else "type" if wanted[name] != found[name] else None)
        rows.append(F.struct(
            F.lit(name).alias("name"), F.lit(wanted.get(name)).cast("string").alias("expected"),
            F.lit(found.get(name)).cast("string").alias("found"), F.lit(told).cast("string").alias("problem"),
            (F.col(name) if name in found else F.lit(0).cast("long")).alias("non_null"),
        ))
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def check_null_rate(df: DataFrame, column: str, ceiling: float) -> DataFrame:
    counts = df.agg(F.count_if(F.col(column).isNull()).alias("nulls"), F.count(F.lit(1)).alias("rows"))
    rate = F.col("nulls") / F.col("rows")
    return _result(counts, f"{column}_null_rate", F.coalesce(rate > ceiling, F.lit(False)),
                   f"{column} null rate within {ceiling}", f"{column} null rate above {ceiling}",
                   F.col("nulls"), [])


def check_row_band(df: DataFrame, low: int, high: int) -> DataFrame:
    counts = df.agg(F.count(F.lit(1)).alias("rows"))
    return _result(counts, "row_band", ~F.col("rows").between(low, high),
                   f"row count in [{low}, {high}]",
                   F.concat(F.lit("unexpected row count: "), F.col("rows").cast("string")),
                   F.when(F.col("rows").between(low, high), 0).otherwise(1), [])


# --- report ----------------------------------------------------------------

CheckFunction = Callable[[DataFrame], DataFrame]
#: Checks that run at the same time.
PARALLEL_CHECKS = 4


def run_all(df: DataFrame, contract: Contract | None = None, today: date | None = None,
            extra: list[CheckFunction] | None = None, parallel: int = PARALLEL_CHECKS) -> DataFrame:
    """Results of all contract rules plus custom checks; they are run here.

    The row rules share one scan, and every custom check is a job of its own
    beside it.  A check that can't be built or fails while it runs, in a UDF or
    on a value, becomes an error result, and all others stand.  If the shared
    scan fails, its rules are run one by one to find the ones that do.  The
    driver receives the results, a bounded row for each check; ``df`` should be
    a stored table.
    """
    contract = contract or Contract.parse()
    spark = df.sparkSession
    rules = contract_rules(contract, df.columns, today)
    # Rules over missing columns can't be built; nothing is run to find out.
    broken = {rule.name: exc for rule in rules if (exc := _failure(lambda r=rule: tally(df, [r]).schema))}
    good = [rule for rule in rules if rule.name not in broken]
    custom = list(extra or [])
    with ThreadPoolExecutor(max(1, parallel)) as pool:
        shared = pool.submit(_rule_rows, df, good)
        others = [pool.submit(_guarded, getattr(check, "__name__", "custom"), lambda c=check: c(df)) for check in custom]
        told = shared.result()
        by_name = {row.check_name: [row] for row in told} | {name: [_crashed(name, exc)] for name, exc in broken.items()}
        rows = [row for rule in rules for row in by_name[rule.name]] + [row for other in others for row in other.result()]
    return check_schema(df, contract).unionByName(results_frame(spark, rows))


def results_frame(spark: SparkSession, rows: list[Row]) -> DataFrame:
    return spark.createDataFrame([tuple(row) for row in rows], RESULT_SCHEMA)


def _rule_rows(df: DataFrame, rules: list[Rule]) -> list[Row]:
    if not rules:
        return []
    try:
        return _collected(run_rules(df, rules))
    except Exception as exc:
        if len(rules) == 1:
            return [_crashed(rules[0].name, exc)]
        return [row for rule in rules for row in _rule_rows(df, [rule])]


def _guarded(name: str, check: Callable[[], DataFrame]) -> list[Row]:
    """The rows of a check that is built and run here, or its failure as one."""
    try:
        return _collected(check())
    except Exception as exc:
        return [_crashed(name, exc)]


def _collected(results: DataFrame) -> list[Row]:
    return results.select(*RESULT_COLUMNS).collect()


def _failure(build: Callable[[], object]) -> Exception | None:
    try:
        build()
    except Exception as exc:
        return exc
    return None


def _crashed(name: str, exc: Exception) -> Row:
    return Row(check_name=name, severity="error", status="fail", message=f"check crashed: {_cause(exc)}", violations=0, samples=[])


def _cause(exc: Exception) -> str:
    """The failure in one line: the error class of Spark's own errors, else the last line of the Python traceback."""
    if isinstance(exc, PySparkException) and (found := exc.getCondition()) and not found.startswith("_LEGACY"):
        return f"{type(exc).__name__}: {found}"
    lines = [line.strip() for line in str(exc).splitlines() if line.strip()]
    errors = [line for line in lines if line.split(":")[0].endswith(("Error", "Exception")) and " " not in line.split(":")[0]]
    last = (errors or lines or [""])[-1]
    if last.startswith("Caused by:") and (root := re.search(r"(\w+(?:Error|Exception)): \[([A-Z_.]+)\]", last)):
        return f"{root[1]}: {root[2]}"  # a Java error that PySpark left as it was
    return f"{type(exc).__name__}: {last}"


def summarize(results: DataFrame) -> DataFrame:
    """One row: totals per status and the overall one."""
    counts = results.agg(
        F.count(F.lit(1)).alias("total_checks"),
        F.count_if(F.col("status") == "pass").alias("passed"),
        F.count_if(F.col("status") == "warn").alias("warned"),
        F.count_if(F.col("status") == "fail").alias("failed"),
    )
    overall = F.when(F.col("failed") > 0, "fail").when(F.col("warned") > 0, "warn").otherwise("pass")
    return counts.withColumn("overall_status", overall)


class ValidationError(RuntimeError):
    """Raised by ``gate``; carries the failed result rows."""

    def __init__(self, failed: list) -> None:
        super().__init__("; ".join(f"{r.check_name}: {r.message}" for r in failed))
        self.failed = failed


def gate(results: DataFrame) -> None:
    """Stop when any check failed (the results are one row per rule)."""
    failed = results.where("status = 'fail'").collect()
    if failed:
        raise ValidationError(failed)
