"""Model answers: parsing, all-or-nothing acceptance, fallback, and scored records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracebook.fixed_values import MODELS
from tracebook.functions.keys import parent_code
from tracebook.functions.once import computed_once
from tracebook.functions.rules import record_rules, split_valid
from tracebook.functions.scoring import pseudo_logprob, with_confidence, with_snippet_match
from tracebook.operators.joins import stamp_company
from tracebook.operators.picks import first_per_key
from tracebook.schemas import RAW, VALUE_TYPE

# An entry of the list as it is read: fields whose type is judged stay variants.
_ENTRY = (
    "struct<source_page:variant,model_confidence:variant,value_numeric:variant,value_text:variant,"
    "unit:string,source_snippet:string,esrs_disclosure:string,metric_name:string>"
)
_INTEGER_TEXT = r"^\s*[+-]?[0-9]+\s*$"
_NUMBER_TEXT = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def with_payload_items(df: DataFrame, payload: Column, name: str) -> DataFrame:
    """Add the list under ``metrics``, null for an unacceptable payload; entries as in ``_ENTRY``.

    The payload must be a JSON object. A missing list is an empty one; an explicit null or
    anything else that is not a list is refused. An entry that is not an object is a null one.
    """
    # within brackets, text behind the object is an error instead of being overlooked
    bracketed = F.try_parse_json(F.concat(F.lit("["), payload, F.lit("]")))
    values = F.try_variant_get(bracketed, "$", "array<struct<metrics:variant>>")
    staged = computed_once(df, {"__values": values})
    head = F.get("__values", F.lit(0))
    listed = F.try_variant_get(head["metrics"], "$", f"array<{_ENTRY}>")
    items = F.when(
        (F.size("__values") == 1) & head.isNotNull(),
        F.when(head["metrics"].isNull(), F.array().cast(f"array<{_ENTRY}>")).otherwise(listed),
    )
    return computed_once(staged, {name: items}).drop("__values")


def _judged(entry: Column) -> Column:
    """The fields of an entry with the kinds that decide how they are read, each looked up once.

    The kind of a variant is VOID for an explicit null, and null for a missing field.
    """
    judged = ("source_page", "model_confidence", "value_numeric", "value_text")
    return F.struct(
        entry.alias("of"), *[F.schema_of_variant(entry[field]).alias(f"{field}_kind") for field in judged]
    )


def _coerced(raw: Column) -> Column:
    """Typed fields of one entry, with ``sound`` false if a coercion fails."""
    entry = raw["of"]

    def read(field: str, kind: str) -> Column:
        return F.try_variant_get(entry[field], "$", kind)

    def number_or_text(field: str, form: str, kind: str) -> Column:
        text = read(field, "string")
        in_form = F.when(text.rlike(form), F.trim(text).try_cast(kind))
        number = read(field, "double")
        return F.when(raw[f"{field}_kind"] == "STRING", in_form).otherwise(
            number if kind == "double" else number.try_cast(kind)
        )

    def read_as(name: str, field: str, *kinds: str) -> Column:
        return F.when(raw[f"{field}_kind"].isin(*kinds), F.lit(None)).otherwise(read(field, name))

    return F.struct(
        parent_code(entry["esrs_disclosure"]).alias("esrs_disclosure"),
        entry["metric_name"].alias("metric_name"),
        read_as("double", "value_numeric", "VOID").alias("value_numeric"),
        read_as("string", "value_text", "VOID").alias("value_text"),
        entry["unit"].alias("unit"),
        number_or_text("model_confidence", _NUMBER_TEXT, "double").alias("model_confidence"),
        number_or_text("source_page", _INTEGER_TEXT, "int").alias("source_page"),
        entry["source_snippet"].alias("source_snippet"),
        *[raw[f"{field}_kind"].alias(f"{field}_kind") for field in ("model_confidence", "value_numeric", "value_text")],
        entry.isNotNull().alias("is_object"),
    )


_FIELDS = (
    "esrs_disclosure", "metric_name", "value_numeric", "value_text", "unit", "model_confidence", "source_page",
    "source_snippet",
)


def _with_soundness(read: Column) -> Column:
    no_number = F.coalesce(read["value_numeric_kind"], F.lit("VOID")) == "VOID"
    sound = (
        read["is_object"]
        & read["source_page"].isNotNull()
        & (read["model_confidence_kind"].isNull() | read["model_confidence"].isNotNull())
        & read["source_snippet"].isNotNull()
        & read["esrs_disclosure"].isNotNull()
        & read["metric_name"].isNotNull()
        & (no_number | (read["value_numeric"].isNotNull() & (read["value_numeric_kind"] != "STRING")))
        & F.coalesce(read["value_text_kind"], F.lit("VOID")).isin("VOID", "STRING")
    )
    return F.struct(*[read[c].alias(c) for c in _FIELDS], F.coalesce(sound, F.lit(False)).alias("sound"))


def coerced_items(items: Column) -> Column:
    """Coerced entries of a payload's list.

    Page and rating may be numbers or number texts, a fractional page number is cut; names,
    codes and quotes may be anything but null; the numeric value must be a number and the
    text value a text, or either may be null or missing. A rating that is missing counts as
    unknown, a rating that is null makes the entry unsound.
    """
    return F.transform(F.transform(F.transform(items, _judged), _coerced), _with_soundness)


def score_records(df: DataFrame, structural: Column | None = None) -> DataFrame:
    """Add ``confidence_score`` from rating, quote and language agreement.

    ``language_match`` is read from the input if there, and taken for true otherwise.
    """
    language_match = F.col("language_match") if "language_match" in df.columns else F.lit(True)
    cited = with_snippet_match(
        df, "__cited_ok", F.col("source_snippet"), F.col("value_numeric"), F.col("value_text")
    )
    scored = with_confidence(
        cited,
        "confidence_score",
        pseudo_logprob(F.col("model_confidence")),
        F.lit(True) if structural is None else structural,
        F.col("__cited_ok"),
        language_match,
    )
    return scored.drop("__cited_ok")


def judged_attempts(payloads: DataFrame) -> DataFrame:
    """One row per attempt with its coerced ``records`` and whether it is ``accepted``.

    One bad entry refuses the whole payload; an empty list is accepted. The entries are
    judged inside the payload's own row, so nothing is shuffled and empty payloads stay.
    """
    parsed = with_payload_items(payloads, F.col("payload"), "__items")
    coerced = computed_once(parsed, {"records": coerced_items(F.col("__items"))})

    def entry_ok(entry: Column) -> Column:
        """The record rules that depend on the entry, applied inside the array."""
        return (
            entry["sound"]
            & F.length(entry["esrs_disclosure"]).between(3, 20)
            & F.length(entry["metric_name"]).between(3, 200)
            & (entry["value_numeric"].isNull() != entry["value_text"].isNull())
            & (entry["value_numeric"].isNull() | entry["value_numeric"].try_cast(VALUE_TYPE).isNotNull())
            & (F.length(F.coalesce(entry["value_text"], F.lit(""))) <= 500)
            & (F.length(F.coalesce(entry["unit"], F.lit(""))) <= 50)
            & (entry["source_page"] >= 1)
            & F.length(entry["source_snippet"]).between(20, 500)
            & entry["source_snippet"].rlike(r"(?U)\S")
        )

    accepted = (
        F.col("error").isNull()
        & F.col("records").isNotNull()
        & F.forall("records", lambda e: F.coalesce(entry_ok(e), F.lit(False)))
    )
    return coerced.select(
        "report_id",
        "topic",
        "model",
        "priority",
        "error",
        "records",
        F.coalesce(accepted, F.lit(False)).alias("accepted"),
    )


def first_accepted(
    attempts: DataFrame,
    keys: Sequence[str] = ("report_id", "topic"),
    priority: str = "priority",
) -> DataFrame:
    """Per work item the accepted attempt of the best priority; model and content settle ties."""
    named = [F.col("model").asc()] if "model" in attempts.columns else []
    order = [F.col(priority).asc(), *named, F.xxhash64(F.to_json(F.struct("*"))).asc()]
    return first_per_key(attempts.where("accepted"), list(keys), order)


def attempt_outcomes(
    work: DataFrame, attempts: DataFrame, keys: Sequence[str] = ("report_id", "topic")
) -> DataFrame:
    """Every work item with its chosen attempt; ``error`` tells why none was accepted.

    The messages of the attempts follow each other in the order in which models are tried.
    """
    named = ["model"] if "model" in attempts.columns else []
    rank = F.struct("priority", *named, F.xxhash64(F.to_json(F.struct("*"))))
    fields = [c for c in attempts.columns if c not in (*keys, "error", "accepted")]
    message = F.concat_ws(": ", "model", F.coalesce("error", F.lit("payload refused")))
    said = F.array_sort(F.collect_list(F.when(~F.col("accepted"), F.struct("priority", message.alias("m")))))
    # one pass over the attempts: payloads are parsed and judged once for choice and messages
    judged = attempts.groupBy(*keys).agg(
        F.min_by(F.struct(*fields), F.when(F.col("accepted"), rank)).alias("__best"),
        F.array_join(F.transform(said, lambda x: x["m"]), "; ").alias("__said"),
    )
    failed = F.when(
        F.col("__best").isNull(), F.coalesce(F.nullif("__said", F.lit("")), F.lit("no attempt"))
    )
    return (
        work.join(judged, list(keys), "left")
        .select("*", *[F.col(f"__best.{c}").alias(c) for c in fields], failed.alias("error"))
        .drop("__best", "__said")
    )


def all_or_nothing(
    df: DataFrame, keys: Sequence[str], valid: Column, name: str = "accepted"
) -> DataFrame:
    """Acceptance of item rows by group: all items valid; counts items per group.

    For items that already are rows. A null verdict counts as invalid.
    """
    verdict = F.coalesce(valid, F.lit(False))
    return df.groupBy(*keys).agg(
        F.bool_and(verdict).alias(name), F.count(F.lit(1)).alias("item_count")
    )


def scored_records(
    chosen: DataFrame, companies: DataFrame, fiscal_year: int, extracted_at: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """Flat landing rows of the chosen attempts: (valid rows, rows that break a rule).

    ``companies`` has ``report_id, ticker, name, language``; it is joined only after the
    fallback has left one payload per work item.
    """
    entries = stamp_company(chosen, companies).select(
        F.col("ticker").alias("company_ticker"),
        F.lit(fiscal_year).cast("short").alias("fiscal_year"),
        F.col("topic").alias("esrs_topic"),
        "language",
        F.col("model").alias("extraction_model"),
        F.inline("records"),
    )
    scored = score_records(entries).withColumns(
        {
            "value_numeric": F.col("value_numeric").try_cast(VALUE_TYPE),
            "extraction_timestamp": F.current_timestamp() if extracted_at is None else extracted_at,
        }
    )
    rows = scored.select(*[F.col(f.name).cast(f.dataType) for f in RAW.fields])
    return split_valid(rows, record_rules())


#: models in the order in which they are tried
MODEL_PRIORITY = {model: position for position, model in enumerate(MODELS)}
