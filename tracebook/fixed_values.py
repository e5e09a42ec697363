"""Enums, limits, catalogue and keyword lists.

These are given constants of the domain. They are listed as plain text so that they
can be compared with their specification by eye; no logic lives here.
"""

# ---- fixed values: enumerations -------------------------------------------------
TOPICS = ("E1", "E2", "E3", "S1", "G1")
LANGUAGES = ("fr", "en")
MODELS = ("claude-sonnet-4-6", "mistral-large-latest")

# ---- fixed values: thresholds and limits ----------------------------------------
CONFIDENCE_THRESHOLD = 0.80
DEFAULT_FISCAL_YEAR = 2024
MISSING_RATING = 0.5
SNIPPET_PENALTY = 0.5
LANGUAGE_PENALTY = 0.7
LOGPROB_SPAN = 5.0
MAX_PAGES = 200
MAX_PROMPT_CHARS = 80_000
PREVIEW_CHARS = 100
REGISTRY_MAX_ENTRIES = 200
FILE_MAGIC = b"%PDF"
# token that the widely used dbt_utils package puts in place of a null key part
KEY_NULL_TOKEN = "_dbt_utils_surrogate_key_null_"

# ---- fixed values: natural key and export order ---------------------------------
NATURAL_KEY = (
    "company_ticker",
    "fiscal_year",
    "esrs_disclosure",
    "metric_name",
    "extraction_model",
)
EXPORT_ORDER = (
    "company_ticker",
    "esrs_topic",
    "esrs_disclosure",
    "metric_name",
    "extraction_model",
)

# ---- fixed values: topic labels --------------------------------------------------
TOPIC_LABELS = {
    "E1": "E1 — Climate change",
    "E2": "E2 — Pollution",
    "E3": "E3 — Water and marine resources",
    "S1": "S1 — Own workforce",
    "G1": "G1 — Business conduct",
}
MODEL_LABELS = {
    "claude-sonnet-4-6": "claude",
    "mistral-large-latest": "mistral",
}

# ---- fixed values: metric catalogue (topic, id, name, unit) ----------------------
METRIC_CATALOGUE = (
    ("E1", "E1-6.scope_1", "Total Scope 1 GHG emissions", "tCO2e"),
    ("E1", "E1-6.scope_2_market", "Total Scope 2 GHG emissions (market-based)", "tCO2e"),
    ("E1", "E1-6.scope_2_location", "Total Scope 2 GHG emissions (location-based)", "tCO2e"),
    ("E1", "E1-6.scope_3", "Total Scope 3 GHG emissions", "tCO2e"),
    ("E1", "E1-5.energy_total", "Total energy consumption", "MWh"),
    ("E1", "E1-5.energy_renewable_pct", "Renewable share of total energy consumption", "%"),
    ("E1", "E1-1.transition_plan_exists", "Climate transition plan disclosed", "boolean"),
    ("E1", "E1-2.net_zero_target_year", "Net-zero target year", "year"),
    ("E2", "E2-4.air_pollutants", "Total air pollutant emissions", "tonnes"),
    ("E2", "E2-5.substances_concern", "Use of substances of concern", "tonnes"),
    ("E3", "E3-4.water_consumption", "Total water consumption", "m3"),
    ("E3", "E3-4.water_withdrawal_stress", "Water withdrawal in water-stressed areas", "m3"),
    ("S1", "S1-6.headcount_total", "Total employees (headcount)", "count"),
    ("S1", "S1-9.gender_diversity_top_mgmt_pct", "% women in top management", "%"),
    ("S1", "S1-14.work_related_injuries", "Number of recordable work-related injuries", "count"),
    ("S1", "S1-14.fatalities", "Number of fatalities from work-related injuries", "count"),
    ("S1", "S1-16.pay_gap_pct", "Gender pay gap (median)", "%"),
    ("G1", "G1-3.confirmed_corruption_incidents", "Confirmed incidents of corruption or bribery", "count"),
    ("G1", "G1-1.business_conduct_policy_exists", "Business-conduct policy disclosed", "boolean"),
)

# ---- fixed values: topic keywords (plain lower-case substrings) ------------------
TOPIC_KEYWORDS = {
    "E1": (
        "scope 1", "scope 2", "scope 3", "ghg", "greenhouse gas", "tco2", "co2e", "co₂e",
        "co2 e", "net-zero", "net zero", "climate", "esrs e1", "energy consumption",
        "renewable", "transition plan",
    ),
    "E2": (
        "air pollutant", "voc", "nox", "sox", "particulate", "pollutant",
        "substances of concern", "esrs e2", "soil contamination",
    ),
    "E3": (
        "water consumption", "water withdrawal", "water-stress", "water stress",
        "freshwater", "esrs e3", "water discharge",
    ),
    "S1": (
        "headcount", "employees", "workforce", "fatalities", "injuries", "lost-time",
        "gender", "pay gap", "esrs s1", "diversity", "training hours",
    ),
    "G1": (
        "business conduct", "code of conduct", "corruption", "bribery", "whistleblower",
        "esrs g1", "ethics", "anti-corruption", "lobbying", "political contribution",
    ),
}
