"""Governance jobs: retention, erasure, export, immutability, classification, lineage, logs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.functions import as_ts, average, bin_floor, pct, ratio
from waybill.operators import storage
from waybill.operators.ordered import in_order
from waybill.operators.rows import top_by, union_all
from waybill.operators.subject_index import SubjectIndex, rows_of

C = F.col

# Days kept per layer; invoices are kept for seven years.
RETENTION_DAYS = {"bronze": 90, "silver": 365, "invoices": 2555, "gold": 2555, "api_log": 365}


# ---------------------------------------------------------------- retention and erasure

def expired(df: DataFrame, day: str, keep_days: int, *, as_of) -> Column:
    return C(day) < F.date_sub(F.to_date(as_ts(as_of)), keep_days)


def purge(spark: SparkSession, path: str, partition: str, keep_days: int, *, as_of) -> list:
    """Drops day partitions older than ``keep_days``; nothing is read or rewritten."""
    table = spark.read.parquet(path)
    old = storage.partition_values(table.filter(expired(table, partition, keep_days, as_of=as_of)),
                                   partition)
    storage._drop(spark, path, partition, old)
    return sorted(old)


ANONYMOUS = "ANONYMIZED"


def anonymised(df: DataFrame, subjects: DataFrame, key: str, columns: Sequence[str],
               keep_key: bool = False) -> DataFrame:
    """Rows of the subjects with personal columns masked and the key replaced by its hash."""
    ids = subjects.select(C(key).alias("_id")).distinct()
    hit = df.join(ids, df[key] == C("_id"), "left").withColumn("_hit", C("_id").isNotNull())
    cells = {c: F.when(C("_hit"), F.lit(ANONYMOUS)).otherwise(C(c)) for c in columns}
    if not keep_key:
        cells[key] = F.when(C("_hit"), F.sha2(C(key), 256)).otherwise(C(key))
    return hit.withColumns(cells).select(*df.columns)


def erase(spark: SparkSession, path: str, partition: str, subjects: DataFrame, key: str,
          columns: Sequence[str], index: SubjectIndex | None = None) -> list:
    """Rewrites the partitions that hold rows of the subjects, masked; returns those partitions.

    With an ``index`` only partitions that may hold some are opened.
    """
    return _rewritten(spark, path, partition, subjects, key, index,
                      lambda rows: anonymised(rows, subjects, key, columns))


def _rewritten(spark: SparkSession, path: str, partition: str, subjects: DataFrame, key: str,
               index: SubjectIndex | None, change) -> list:  # noqa: ANN001
    table = storage.table(spark, path, partition)
    if index:
        table = table.filter(storage._in(partition, [
            None if v == storage.NO_VALUE else v for v in index.may_hold(subjects)]))
    ids = subjects.select(C(key).alias("_id")).distinct()
    held = table.join(ids, table[key] == C("_id"), "left_semi")
    touched = storage.partition_values(held, partition)
    if touched:
        storage._overwrite(change(table.filter(storage._in(partition, touched))), path, partition)
        if index:
            index.refresh()
    return touched


def rectify(spark: SparkSession, path: str, partition: str, corrections: DataFrame, key: str,
            columns: Sequence[str], index: SubjectIndex | None = None) -> list:
    """Writes corrected values (key, columns; null: as it was) into all rows of their subjects;
    returns the partitions rewritten. Two corrections of one subject are refused."""
    storage.check_unique(corrections, [key])

    def change(rows: DataFrame) -> DataFrame:
        new = corrections.select(C(key).alias("_id"), *(C(c).alias(f"_{c}") for c in columns))
        cells = {c: F.coalesce(C(f"_{c}"), C(c)) for c in columns}
        return rows.join(new, C(key) == C("_id"), "left").withColumns(cells).select(*rows.columns)

    return _rewritten(spark, path, partition, corrections, key, index, change)


def erase_everywhere(spark: SparkSession, tables: Mapping[str, SubjectIndex], subjects: DataFrame,
                     columns: Mapping[str, Sequence[str]], kept: Sequence[str], log: str, *,
                     as_of) -> dict[str, list]:
    """Erases subjects from all tables and enters it in the log; ``kept`` names tables that must
    keep them. The log is written last: a run that stops is repeated as a whole, and masked rows
    are not found again. Returns the partitions rewritten."""
    key = next(iter(tables.values())).key
    with storage.staged(subjects.select(key).distinct(), log) as ids:
        done = {name: erase(spark, index.path, index.partition, ids, key, columns[name], index)
                for name, index in tables.items()}
        storage.append(erasure_log(ids, key, list(tables), kept, as_of=as_of), log)
    return done


def erasure_log(subjects: DataFrame, key: str, tables: Sequence[str], kept: Sequence[str], *,
                as_of) -> DataFrame:
    """Audit rows, one per subject and table, naming subjects only by hash."""
    cells = [F.struct(F.lit(t).alias("table_name"), F.lit("anonymized").alias("action"))
             for t in tables]
    cells += [F.struct(F.lit(t).alias("table_name"), F.lit("kept").alias("action")) for t in kept]
    return subjects.select(F.sha2(C(key), 256).alias("subject_hash"), F.inline(F.array(*cells))) \
        .withColumn("erased_at", as_ts(as_of))


def subject_rows(tables: Mapping[str, DataFrame], subject: str, key: str = "customer_id"
                 ) -> DataFrame:
    """All rows about a subject: table name and the row as JSON."""
    return union_all([df.filter(C(key) == subject).select(
        F.lit(name).alias("table_name"), F.to_json(F.struct(*df.columns)).alias("record"))
        for name, df in tables.items()])


def export_indexed(tables: Mapping[str, SubjectIndex], subjects: DataFrame, path: str,
                   fmt: str = "json") -> None:
    """Writes the subjects' rows, one folder per table, opening only partitions that may hold
    some."""
    for name, index in tables.items():
        writer = rows_of(index, subjects).write.mode("overwrite")
        if fmt not in ("json", "csv"):
            raise ValueError(f"unknown format {fmt!r}")
        (writer.option("header", True).csv if fmt == "csv" else writer.json)(
            f"{path.rstrip('/')}/{name}")


def export_subject(tables: Mapping[str, DataFrame], subject: str, path: str,
                   key: str = "customer_id", fmt: str = "json") -> None:
    """Writes a subject's rows, one folder per table, as JSON or CSV."""
    for name, df in tables.items():
        writer = df.filter(C(key) == subject).write.mode("overwrite")
        target = f"{path.rstrip('/')}/{name}"
        if fmt == "json":
            writer.json(target)
        elif fmt == "csv":
            writer.option("header", True).csv(target)
        else:
            raise ValueError(f"unknown format {fmt!r}")


def split_immutable(incoming: DataFrame, stored: DataFrame, key: str, date: str,
                    columns: Sequence[str], days: int = 30, *, as_of
                    ) -> tuple[DataFrame, DataFrame]:
    """Accepted rows, and rows that would change a stored one older than ``days`` days."""
    old = stored.select(C(key).alias("_key"), F.to_date(date).alias("_date"),
                        F.struct(*columns).alias("_stored"))
    joined = incoming.join(old, incoming[key] == C("_key"), "left")
    frozen = C("_date") < F.date_sub(F.to_date(as_ts(as_of)), days)
    differs = ~F.struct(*columns).eqNullSafe(C("_stored"))
    bad = F.coalesce(C("_key").isNotNull() & frozen & differs, F.lit(False))
    cols = incoming.columns
    return (joined.filter(~bad).select(*cols),
            joined.filter(bad).select(*cols, F.lit("immutable record changed")
                                      .alias("reject_reason")))


# ---------------------------------------------------------------- lifecycle

# Order of the order states.
STATUS_RANK = {"Pending": 1, "Confirmed": 2, "In Progress": 3, "Shipped": 4, "Delivered": 5}


def lifecycle_violations(history: DataFrame, key: str, status: str, ts: str,
                         tie: str) -> DataFrame:
    """Steps back in the lifecycle, and cancellations after shipping."""
    ranked = in_order(history, [key], [ts, tie], [status])
    pairs = [F.lit(x) for kv in STATUS_RANK.items() for x in kv]
    rank = F.create_map(*pairs)

    def at(c: Column) -> Column:
        return F.try_element_at(rank, c)

    before = C("previous").getField(status)
    late_cancel = (C(status) == "Cancelled") & before.isin("Shipped", "Delivered")
    revived = (before == "Cancelled") & (C(status) != "Cancelled")
    backwards = at(C(status)) < at(before)
    reason = (F.when(late_cancel, "cancelled after shipping").when(revived, "left Cancelled")
              .when(backwards, "moved backwards"))
    return ranked.withColumns({"violation": reason, "previous_status": before}).filter(
        C("violation").isNotNull()).drop("previous")


# ---------------------------------------------------------------- classification

# Patterns of personal data.
PATTERNS = {
    "EMAIL": r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$",
    "PHONE_NUMBER": r"^[+]?[(]?[0-9]{1,4}[)]?[-\s\.]?[(]?[0-9]{1,4}[)]?[-\s\.]?[0-9]{1,9}$",
}
CONTAINS_EMAIL = r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"


def classify(df: DataFrame, columns: Sequence[str],
             patterns: Mapping[str, str] = PATTERNS, minimum: int = 80) -> DataFrame:
    """Share of non-null values that match each pattern, per column, in one pass."""
    pairs = [(c, name, pattern) for c in columns for name, pattern in patterns.items()]
    counts = df.agg(*[F.count(c).alias(f"_n{i}") for i, (c, _, _) in enumerate(pairs)],
                    *[F.count_if(C(c).rlike(p)).alias(f"_{i}")
                      for i, (c, _, p) in enumerate(pairs)])
    rows = []
    for i, (c, name, _) in enumerate(pairs):
        share = pct(C(f"_{i}"), C(f"_n{i}"))
        rows.append(F.struct(F.lit(c).alias("column_name"), F.lit(name).alias("classification"),
                             C(f"_{i}").alias("matches"), share.alias("match_pct"),
                             F.coalesce(share >= minimum, F.lit(False)).alias("classified")))
    return counts.select(F.inline(F.array(*rows)))


# ---------------------------------------------------------------- lineage and reports

def lineage_row(spark: SparkSession, source: str, target: str, process: str,
                result: DataFrame, *, as_of) -> DataFrame:
    """One lineage record for a refresh; the row count comes from the written table."""
    return result.agg(F.count("*").alias("row_count")).select(
        F.lit(source).alias("source"), F.lit(target).alias("target"),
        F.lit(process).alias("process"), "row_count", as_ts(as_of).alias("run_at"))


def weekly_report(results: DataFrame, access: DataFrame, *, as_of) -> DataFrame:
    """One row for the last seven days: score, change to the week before, open and resolved
    issues, calls, users and violations.

    ``results`` is the rule history (rule_id, status, checked_at); ``access`` the access log
    (ts, user, partner).
    """
    end = as_ts(as_of)
    week = F.expr("INTERVAL 7 DAYS")
    this, last = C("checked_at") > end - week, C("checked_at").between(end - week - week,
                                                                       end - week)
    good = C("status") == "Pass"
    scores = results.agg(
        pct(F.count_if(this & good), F.count_if(this)).alias("quality_score"),
        pct(F.count_if(last & good), F.count_if(last)).alias("previous_score"))
    newest = results.filter(C("checked_at") > end - week - week).groupBy("rule_id").agg(
        F.max_by("status", "checked_at").alias("now"),
        F.max(F.when(last & ~good, 1)).alias("failed_before"))
    issues = newest.agg(F.count_if(C("now") == "Fail").alias("open"),
                        F.count_if((C("now") == "Pass") & (C("failed_before") == 1))
                        .alias("resolved"))
    calls = access.filter(C("ts") > end - week).agg(
        F.count("*").alias("calls"), F.count_distinct("user").alias("users"),
        F.count_if(C("partner").isNull() | (C("partner") == "")).alias("violations"))
    return scores.select(
        F.to_date(end).alias("report_date"), "quality_score",
        (C("quality_score") - C("previous_score")).alias("score_change"),
        *[issues.select(c).scalar().alias(f"{c}_issues") for c in ("open", "resolved")],
        *[calls.select(c).scalar().alias(n) for c, n in (
            ("calls", "api_calls"), ("users", "unique_users"),
            ("violations", "access_violations"))])


def top_consumers(access: DataFrame, n: int = 10, *, as_of) -> DataFrame:
    """Who called most in the last seven days."""
    calls = access.filter(C("ts") > as_ts(as_of) - F.expr("INTERVAL 7 DAYS")).groupBy("user").agg(
        F.count("*").alias("calls"))
    return top_by(calls, n, F.desc("calls"), "user")


def weekly_compliance(requests: DataFrame, partitions: DataFrame, columns: DataFrame, *, as_of
                      ) -> DataFrame:
    """One row for the last seven days: requests of subjects and hours until they were met, share
    of partitions within their retention, share of columns with a classification.

    ``requests``: requested_at, fulfilled_at; ``partitions``: day, keep_days; ``columns``:
    classification, null where there is none.
    """
    end = as_ts(as_of)
    asked = requests.filter((C("requested_at") > end - F.expr("INTERVAL 7 DAYS"))
                            & (C("requested_at") <= end))
    seconds = F.unix_seconds("fulfilled_at") - F.unix_seconds("requested_at")
    within = C("day") >= F.date_sub(F.to_date(end), C("keep_days"))
    one = asked.agg(F.count("*").alias("subject_requests"), F.count("fulfilled_at").alias("fulfilled"),
                    ratio(F.sum(seconds), F.count("fulfilled_at") * 3600).alias("avg_hours"))
    kept = partitions.agg(pct(F.count_if(within), F.count("*")).alias("v"))
    known = columns.agg(pct(F.count("classification"), F.count("*")).alias("v"))
    return one.select(F.to_date(end).alias("report_date"), "*",
                      kept.scalar().alias("retention_compliance"),
                      known.scalar().alias("classification_coverage"))


# ---------------------------------------------------------------- access log

def requests_per_partner(log: DataFrame, seconds: int = 300) -> DataFrame:
    return log.groupBy(bin_floor(C("ts"), seconds).alias("bin"), "partner").agg(
        F.count("*").alias("request_count"))


def response_times(log: DataFrame, seconds: int = 300) -> DataFrame:
    """Exact percentiles per time bin; equal times are counted first."""
    counts = log.groupBy(bin_floor(C("ts"), seconds).alias("bin"), "response_ms").agg(
        F.count("*").alias("n"))
    return counts.groupBy("bin").agg(
        F.sum("n").alias("requests"),
        *[F.round(F.percentile("response_ms", p, C("n")), 4).alias(f"p{round(p * 100)}")
          for p in (0.5, 0.95, 0.99)])


def errors_by_code(log: DataFrame, seconds: int = 300) -> DataFrame:
    return log.filter(C("response_code") >= 400).groupBy(
        bin_floor(C("ts"), seconds).alias("bin"), "response_code").agg(
        F.count("*").alias("error_count"))


def slowest(log: DataFrame, n: int = 20) -> DataFrame:
    return top_by(log, n, F.desc("response_ms"), "request_id")


def availability(log: DataFrame, days: int = 30, target: str = "99.9", *, as_of) -> DataFrame:
    """Share of requests that did not fail, against the target."""
    rows = log.filter(C("ts") > as_ts(as_of) - F.make_dt_interval(F.lit(days)))
    ok = F.count_if(C("response_code") < 400)
    goal = F.lit(target).cast("decimal(5,2)")
    out = rows.agg(F.count("*").alias("total_requests"), ok.alias("successful_requests"),
                   pct(ok, F.count("*")).alias("availability"),
                   average(C("response_ms")).alias("avg_response_ms"))
    met = C("successful_requests") * 100 >= C("total_requests") * goal
    return out.withColumns({"sla_target": goal,
                            "sla_met": F.when(met, "Yes").otherwise("No")})


def partner_of_text(text: Column) -> Column:
    """Partner named in a logged query text; empty when there is none."""
    return F.regexp_extract(text, r"PartnerID.*?'([^']*)'", 1)
