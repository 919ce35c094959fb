"""Chat messages: splitting into vacancies, attribute extraction, statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsignal import dictionaries as D
from jobsignal.functions import scalars as X

_MARK = "\u0001"


def split_parts(text: Column) -> Column:
    """Message to part texts.

    A blank line closes a part only when a subscription sign stands before it on the
    same line; any other blank line shrinks to one line end.
    """
    marked = F.replace(text, F.lit("\n\n"), F.lit(_MARK))
    cut = F.regexp_replace(marked, rf"(?d)((?:{D.any_of(D.SPLITTER_SIGNS)}).*?){_MARK}", "$1\n\n")
    return F.split(F.replace(cut, F.lit(_MARK), F.lit("\n")), "\n\n", -1)


def number_parts(messages: DataFrame, text: str = "text") -> DataFrame:
    """One row per part with its 0-based ``part_no``; empty messages have no parts."""
    kept = [c for c in messages.columns if c != text]
    return (messages.where(F.col(text) != "")
            .select(*kept, F.posexplode(split_parts(F.col(text))).alias("part_no", "part")))


def extract_vacancies(messages: DataFrame, text: str = "text") -> DataFrame:
    """Vacancy attributes of every part of the given vacancy messages.

    Parts a vacancy cannot be read from keep a ``quarantine`` reason; their siblings
    are unaffected.
    """
    kept = [c for c in messages.columns if c != text]
    lines = F.split(X.strip(F.col("part")), "\n", -1)
    numbered = number_parts(messages, text).withColumn("lines", lines)
    line = lambda i: F.coalesce(F.get("lines", F.lit(i)), F.lit(""))
    place = rf"(?d)(.+), {D.NUMERIC_PATTERN}? ?({D.any_of(D.EXPERIENCE_SIGNS)})"
    texts = numbered.select(
        *kept, "part_no", "part", "lines",
        X.strip_markup(line(0)).alias("first"), X.strip_markup(line(1)).alias("second"),
        X.strip_markup(F.element_at("lines", -1)).alias("last"),
        F.array_join("lines", "\n").alias("body"))
    # A place found has a character at least; without one the second line doesn't tell it.
    head = texts.select("*", F.regexp_extract("second", place, 1).alias("place"), F.regexp_extract("second", place, 2).alias("years"))

    second, names = F.col("second"), F.split("first", D.any_of(D.POSITION_COMPANY_SIGNS), -1)
    placed, years = F.col("place") != "", F.col("years")
    bounds = X.salary_bounds(second)
    subscription = F.regexp_replace("last", D.any_of(D.SUBSCRIPTION_SIGNS), "")
    n = F.size("lines")
    fields = head.select(
        *kept, "part_no", "part", "body",
        F.get(names, F.lit(0)).alias("position"),
        F.get(names, F.lit(1)).alias("company"),
        F.when(placed, F.col("place")).alias("location"),
        F.when(placed & (years == ""), F.lit(0.0)).when(placed, X.to_numeric(years)).alias("experience"),
        bounds.alias("bounds"),
        F.when(n > 4, F.array_join(F.slice("lines", F.lit(3), F.greatest(n - 4, F.lit(0))), "\n"))
        .otherwise("").alias("job_desc_prev"),
        X.group_or_null(F.col("body"), f"(?d)({D.URL_PATTERN})").alias("url"),
        F.when(subscription != "", F.regexp_replace(subscription, r"\A[\"' *_`]+|[\"' *_`]+\z", ""))
        .alias("subscription"),
        (n < 2).alias("single_line"))
    priced = F.contains("body", F.lit("$"))
    found = (fields.withColumn("salary_from", X.truthy(F.col("bounds.lo")))
             .withColumn("salary_to", X.truthy(F.col("bounds.hi"))))
    audit = [("position", None), ("job_desc_prev", None), ("location", None), ("experience", None),
             ("salary_from", priced), ("salary_to", priced), ("company", None), ("url", None),
             ("subscription", None)]
    return found.select(
        *kept, "part_no", "position", "location", "experience", "salary_from", "salary_to", "job_desc_prev",
        "company", "subscription", "url",
        X.missing_report(audit, bare_single=True).alias("parsing_error"),
        F.when(F.col("single_line"), F.lit("single_line_part")).when(F.col("url").isNull(), F.lit("missing_url"))
        .alias("quarantine"), F.col("part").alias("payload"))


STATISTIC_FIELDS = ["vacancies_in_30d", "candidates_online", "responses_to_vacancies", "vacancies_per_week",
                    "candidates_per_week"]


def extract_statistics(messages: DataFrame, text: str = "text") -> DataFrame:
    """Seven market measures of every statistic message and their audit text."""
    kept = [c for c in messages.columns if c != text]
    source = F.col(text)

    def measure(name: str) -> Column:
        return X.to_numeric(F.regexp_extract(
            source, rf"(?:{D.any_of(D.STATISTIC_SIGNS[name])}):? +{D.NUMERIC_PATTERN}", 1))

    salary = rf"(?:{D.any_of(D.STATISTIC_SIGNS['salary'])}):? +{D.SALARY_RANGE_PATTERN}"
    found = messages.select(
        *kept, *[measure(name).alias(name) for name in STATISTIC_FIELDS],
        X.to_numeric(F.regexp_extract(source, salary, 1)).alias("min_salary"),
        X.to_numeric(F.regexp_extract(source, salary, 2)).alias("max_salary"))
    report = X.missing_report([(f, None) for f in STATISTIC_FIELDS], bare_single=False)
    return found.withColumn("stat_parsing_error", report)


def raw_audit(messages: DataFrame) -> DataFrame:
    """Chat raw rows with the audit of the fields every message should carry."""
    fields = [(name, None) for name in ("date", "message_id", "text")]
    return messages.withColumn("raw_parsing_error", X.missing_report(fields, bare_single=False))
