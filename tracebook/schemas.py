"""Declared schemas. Nothing is inferred anywhere in the package."""

from __future__ import annotations

from pyspark.sql import types as T

VALUE_TYPE = T.DecimalType(28, 6)
SCORE_TYPE = T.DecimalType(4, 3)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


_TEXT = T.StringType()

#: nested record as archived in JSON
RECORD = _struct(
    company_ticker=_TEXT,
    fiscal_year=T.ShortType(),
    esrs_topic=_TEXT,
    esrs_disclosure=_TEXT,
    metric_name=_TEXT,
    value_numeric=T.DoubleType(),
    value_text=_TEXT,
    unit=_TEXT,
    confidence_score=T.DoubleType(),
    source_citation=_struct(page=T.IntegerType(), snippet=_TEXT),
    language=_TEXT,
    extraction_model=_TEXT,
    extraction_timestamp=T.TimestampType(),
)

#: flat landing row, 14 columns in load order
RAW = _struct(
    company_ticker=_TEXT,
    fiscal_year=T.ShortType(),
    esrs_topic=_TEXT,
    esrs_disclosure=_TEXT,
    metric_name=_TEXT,
    value_numeric=VALUE_TYPE,
    value_text=_TEXT,
    unit=_TEXT,
    confidence_score=SCORE_TYPE,
    source_page=T.IntegerType(),
    source_snippet=_TEXT,
    language=_TEXT,
    extraction_model=_TEXT,
    extraction_timestamp=T.TimestampType(),
)

COMPANIES = _struct(
    ticker=_TEXT, name=_TEXT, sector=_TEXT, country=_TEXT, ir_page_url=_TEXT, language=_TEXT
)
REGISTRY = T.StructType(
    COMPANIES.fields[:5]
    + [T.StructField("known_report_url", _TEXT, True), COMPANIES.fields[5]]
)
METRICS = _struct(esrs_topic=_TEXT, esrs_disclosure=_TEXT, metric_name=_TEXT, unit=_TEXT)
PERIODS = _struct(
    fiscal_year=T.ShortType(),
    period_start=T.DateType(),
    period_end=T.DateType(),
    reporting_basis=_TEXT,
)

#: the declared mart tables: keys in front, then the attributes
_KEY = _TEXT
_ROUTED = dict(
    disclosure_id=_KEY,
    company_ticker=_TEXT,
    company_name=_TEXT,
    sector=_TEXT,
    country=_TEXT,
    esrs_topic=_TEXT,
    esrs_disclosure=_TEXT,
    metric_name=_TEXT,
    fiscal_year=T.ShortType(),
    value_numeric=VALUE_TYPE,
    value_text=_TEXT,
    unit=_TEXT,
    confidence_score=SCORE_TYPE,
    source_page=T.IntegerType(),
    source_snippet=_TEXT,
    language=_TEXT,
    extraction_model=_TEXT,
    extraction_timestamp=T.TimestampType(),
)
MARTS = {
    "dim_company": T.StructType([T.StructField("company_id", _KEY), *COMPANIES.fields]),
    "dim_metric": _struct(
        metric_id=_KEY,
        esrs_topic=_TEXT,
        esrs_disclosure=_TEXT,
        metric_name=_TEXT,
        unit=_TEXT,
        mandatory_flag=T.BooleanType(),
        is_in_catalog=T.BooleanType(),
    ),
    "dim_period": T.StructType([T.StructField("period_id", _KEY), *PERIODS.fields]),
    "fact_disclosure": _struct(
        disclosure_id=_KEY,
        company_id=_KEY,
        metric_id=_KEY,
        period_id=_KEY,
        value_numeric=VALUE_TYPE,
        value_text=_TEXT,
        unit=_TEXT,
        confidence_score=SCORE_TYPE,
        source_page=T.IntegerType(),
        source_snippet=_TEXT,
        language=_TEXT,
        extraction_model=_TEXT,
        extraction_timestamp=T.TimestampType(),
        human_approved=T.BooleanType(),
    ),
    "mart_disclosure_published": _struct(**_ROUTED),
    "mart_disclosure_review_queue": _struct(**_ROUTED, human_approved=T.BooleanType()),
}
EXPOSURES = _struct(ticker=_TEXT, exposure_eur_m=T.IntegerType())
APPROVALS = _struct(disclosure_id=_TEXT, human_approved=T.BooleanType())

#: report pages, 1-indexed
PAGES = _struct(report_id=_TEXT, page=T.IntegerType(), text=_TEXT)

#: one model answer per (report, topic, model)
PAYLOADS = _struct(
    report_id=_TEXT,
    topic=_TEXT,
    model=_TEXT,
    priority=T.IntegerType(),
    payload=_TEXT,
    error=_TEXT,
)
