"""Report pages: splitting, topic filter, text budget, assembly and prompt rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracebook.fixed_values import (
    MAX_PAGES,
    MAX_PROMPT_CHARS,
    METRIC_CATALOGUE,
    TOPIC_KEYWORDS,
)
from tracebook.functions.once import computed_once
from tracebook.operators.joins import contains_any

# fixed value: page header form and the blank line between pages
HEADER_PATTERN = r"\[page ([0-9]+)\]"
PAGE_BREAK = "\n\n"

# Slices of a hot group in the first pass. Lengths are all that the passes carry, so the second
# pass sees this many budgets of short rows per group, however wide the cluster shuffles.
SLICES = 64


def page_header(page: Column) -> Column:
    return F.concat(F.lit("[page "), page.cast("string"), F.lit("]"))


def page_rows(pages: DataFrame, max_pages: int | None = MAX_PAGES) -> DataFrame:
    """Pages of every report, missing text as empty text, first ``max_pages`` pages only."""
    capped = pages if max_pages is None else pages.where(F.col("page") <= max_pages)
    return capped.withColumn("text", F.coalesce(F.col("text"), F.lit("")))


def split_report(reports: DataFrame, text: str = "text") -> DataFrame:
    """One row per page from marked-up report strings.

    A page runs from its header to the next header; text before the first header belongs
    to no page. ``chunk`` is the page as it stands, with header and trailing blank line.
    """
    parts = F.split(F.col(text), rf"(?={HEADER_PATTERN})")
    pages = reports.select(
        *[c for c in reports.columns if c != text],
        F.explode(parts).alias("chunk"),
    ).where(F.col("chunk").rlike(f"^{HEADER_PATTERN}"))
    number = F.regexp_extract("chunk", f"^{HEADER_PATTERN}", 1).cast("int")
    body = F.regexp_replace(F.col("chunk"), rf"^{HEADER_PATTERN}\n?", "")
    return pages.select("*", number.alias("page"), body.alias("text"))


def assemble_reports(pages: DataFrame, max_pages: int | None = MAX_PAGES) -> DataFrame:
    """Marked-up text and page count per report, from its first ``max_pages`` pages.

    The page limit is part of the operation and bounds what one group collects; without one
    a report is as long as its pages make it.
    """
    parts = page_rows(pages, max_pages).select(
        "report_id",
        "page",
        F.concat(page_header(F.col("page")), F.lit("\n"), F.col("text")).alias("part"),
    )
    return parts.groupBy("report_id").agg(
        _joined_in_order(F.struct("page", "part"), "part", PAGE_BREAK).alias("text"),
        F.count(F.lit(1)).alias("page_count"),
    )


def _joined_in_order(entry: Column, field: str, separator: str) -> Column:
    ordered = F.sort_array(F.collect_list(entry))
    return F.array_join(F.transform(ordered, lambda e: e[field]), separator)


# ---- prefix within a budget --------------------------------------------------------


@dataclass(frozen=True)
class Lane:
    """One running total over the ordered rows of a group.

    ``cost`` is null for a row that takes no part. A row stays in the lane while the total
    including it is within ``budget``, or, for a ``covering`` lane, while the total before
    it is below the budget (the last row then reaches beyond).
    """

    cost: Column
    budget: int
    covering: bool = False


def _totals_before(
    df: DataFrame, lanes: Mapping[str, str], group: Sequence[str], order: Sequence[str]
) -> DataFrame:
    window = (
        Window.partitionBy(*group)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return df.withColumns(
        {
            f"__before_{lane}": F.coalesce(F.sum(F.coalesce(cost, F.lit(0))).over(window), F.lit(0))
            for lane, cost in ((lane, F.col(c)) for lane, c in lanes.items())
        }
    )


def prefix_within_budget(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    lanes: Mapping[str, Lane],
    between=lambda survivors: survivors,
    split: int = SLICES,
) -> DataFrame:
    """Rows that stay in at least one lane, with the array ``kept`` of their lanes.

    A group may be far larger than its budget, so it is first cut in ``split`` slices by a
    hash of its order columns. Within a slice the total is at most the total within the
    group, hence a row that starts beyond the budget in its slice can go; the first row to
    cross the budget stays and keeps every later row out. The second pass then sees, per
    group, no more than ``split`` budgets of text. ``between`` may refine the survivors
    (and lower the cost of a group's last row) before the second pass.
    """
    costs = {lane: f"__cost_{lane}" for lane in lanes}
    rows = df.withColumns({costs[lane]: spec.cost for lane, spec in lanes.items()})
    rows = rows.where(F.coalesce(*[F.col(c) for c in costs.values()]).isNotNull())
    rows = rows.withColumn("__slice", F.pmod(F.xxhash64(*order), F.lit(split)))

    within_slice = _totals_before(rows, costs, [*group, "__slice"], order)
    may_stay = [
        F.col(costs[lane]).isNotNull()
        & (
            F.col(f"__before_{lane}") < spec.budget
            if spec.covering
            else F.col(f"__before_{lane}") <= spec.budget
        )
        for lane, spec in lanes.items()
    ]
    survivors = within_slice.where(_any_of(may_stay)).drop(
        "__slice", *[f"__before_{lane}" for lane in lanes]
    )

    within_group = _totals_before(between(survivors), costs, group, order)
    kept = F.filter(
        F.array(
            *[
                F.when(
                    F.col(costs[lane]).isNotNull()
                    & (
                        F.col(f"__before_{lane}") < spec.budget
                        if spec.covering
                        else F.col(f"__before_{lane}") + F.col(costs[lane]) <= spec.budget
                    ),
                    F.lit(lane),
                )
                for lane, spec in lanes.items()
            ]
        ),
        lambda lane: lane.isNotNull(),
    )
    return (
        within_group.withColumn("kept", kept)
        .where(F.size("kept") > 0)
        .drop(*costs.values(), *[f"__before_{lane}" for lane in lanes])
    )


def _any_of(conditions: Sequence[Column]) -> Column:
    result = conditions[0]
    for condition in conditions[1:]:
        result = result | condition
    return result


# ---- topic excerpts ----------------------------------------------------------------

_HEAD = "head"


def topic_excerpts(
    pages: DataFrame,
    topics: Mapping[str, Sequence[str]] = TOPIC_KEYWORDS,
    max_chars: int = MAX_PROMPT_CHARS,
    split: int = SLICES,
) -> DataFrame:
    """The excerpt of every (report, topic): matching pages within the text budget.

    ``pages(report_id, page, text)`` has one row per page; numbers may have gaps. A page
    matches a topic if its lower-cased text contains one of the topic's keywords. Matching
    pages are taken in page order until the first one that would break the budget; if none
    was taken, the excerpt is the first ``max_chars`` characters of the report.

    The budget is decided on page lengths and hits alone, for all topics in one pass; text is
    fetched afterwards for the pages that were taken.
    """
    header = page_header(F.col("page"))
    chunk = F.concat(header, F.lit("\n"), F.coalesce("text", F.lit("")), F.lit(PAGE_BREAK))
    numbered = pages.select("report_id", "page", "text")
    searched = computed_once(numbered, {"length": F.length(chunk), "__lower": F.lower(chunk)})
    flagged = searched.select(
        "report_id",
        "page",
        "length",
        *[contains_any(F.col("__lower"), words).alias(f"__hit_{topic}") for topic, words in topics.items()],
    )
    length = F.col("length")
    lanes = {
        topic: Lane(F.when(F.col(f"__hit_{topic}"), length), max_chars) for topic in topics
    }
    lanes[_HEAD] = Lane(length, max_chars, covering=True)
    last_pages = pages.groupBy("report_id").agg(F.max("page").alias("__last"))

    def without_final_break(survivors: DataFrame) -> DataFrame:
        """The last page of a report has no blank line behind it."""
        joined = survivors.join(last_pages, "report_id")
        less = F.when(F.col("page") == F.col("__last"), len(PAGE_BREAK)).otherwise(0)
        return joined.withColumns(
            {f"__cost_{lane}": F.col(f"__cost_{lane}") - less for lane in lanes}
        )

    taken = prefix_within_budget(
        flagged, ["report_id"], ["page"], lanes, without_final_break, split
    ).select("report_id", "page", "__last", "kept")
    whole = F.when(
        F.col("page") == F.col("__last"),
        F.concat(header, F.lit("\n"), F.coalesce("text", F.lit(""))),
    ).otherwise(chunk)
    kept = taken.join(numbered, ["report_id", "page"]).withColumn("chunk", whole)

    def texts(lane: str) -> Column:
        return F.collect_list(
            F.when(F.array_contains("kept", lane), F.struct("page", "chunk"))
        )

    collected = kept.groupBy("report_id").agg(
        *[texts(lane).alias(f"__in_{lane}") for lane in lanes]
    )
    head = F.substring(_in_order(f"__in_{_HEAD}", ""), 1, max_chars)
    rows = F.array(
        *[
            F.struct(
                F.lit(position).alias("topic_position"),
                F.lit(topic).alias("topic"),
                F.size(f"__in_{topic}").alias("page_count"),
                F.when(F.size(f"__in_{topic}") > 0, _in_order(f"__in_{topic}", PAGE_BREAK)).alias(
                    "selected"
                ),
            )
            for position, topic in enumerate(topics)
        ]
    )
    unfolded = collected.select("report_id", head.alias("head"), F.inline(rows))
    return unfolded.select(
        "report_id",
        "topic_position",
        "topic",
        "page_count",
        F.col("selected").isNull().alias("from_head"),
        F.coalesce("selected", "head").alias("excerpt"),
    )


def _in_order(column: str, separator: str) -> Column:
    return F.array_join(F.transform(F.sort_array(F.col(column)), lambda e: e["chunk"]), separator)


# ---- prompts -----------------------------------------------------------------------


def catalogue_lines(topic: str, catalogue=METRIC_CATALOGUE) -> str:
    """Catalogue entries of a topic, one line each, under their parent code."""
    return "\n".join(
        f"  - {code.split('.')[0]}: {name} (unit: {unit})"
        for entry_topic, code, name, unit in catalogue
        if entry_topic == topic
    )


PROMPT_HEAD = (
    "Read the report excerpt and list the figures it discloses.\n"
    "\n"
    "Company: {company}\n"
    "Fiscal year: {year}\n"
    "Topic: {topic}\n"
    "Language: {language}\n"
    "\n"
    "Figures wanted:\n"
    "{catalogue}\n"
    "\n"
    "Answer with a JSON object holding a list named metrics. Give only values written in the\n"
    "excerpt, each with its page (source_page), a quote of at least 20 characters\n"
    "(source_snippet), the parent code (esrs_disclosure), the name as listed (metric_name),\n"
    "either value_numeric or value_text, the unit, and your certainty between 0 and 1\n"
    "(model_confidence). Leave out what is not disclosed; answer yes-no figures as text.\n"
    "\n"
    "Excerpt:\n"
    "---\n"
)
PROMPT_TAIL = "\n---\n"


def prompt_rows(
    excerpts: DataFrame,
    companies: DataFrame,
    fiscal_year: int,
    topics: Sequence[str] = tuple(TOPIC_KEYWORDS),
    catalogue=METRIC_CATALOGUE,
) -> DataFrame:
    """One prompt per (report, topic): a head with catalogue lines, then the excerpt.

    ``companies`` has ``report_id, name, language``.
    """
    lines = F.lit("")
    for topic in topics:
        lines = F.when(F.col("topic") == topic, F.lit(catalogue_lines(topic, catalogue))).otherwise(
            lines
        )
    values = {
        "company": F.col("name"),
        "year": F.lit(str(fiscal_year)),
        "topic": F.col("topic"),
        "language": F.col("language"),
        "catalogue": lines,
    }
    pieces: list[Column] = []
    rest = PROMPT_HEAD
    for field, value in values.items():
        before, rest = rest.split("{" + field + "}", 1)
        pieces += [F.lit(before), value]
    prompt = F.concat(*pieces, F.lit(rest), F.col("excerpt"), F.lit(PROMPT_TAIL))
    named = excerpts.join(companies.select("report_id", "name", "language"), "report_id")
    return named.select("report_id", "topic_position", "topic", prompt.alias("prompt"))
