"""Row input contracts on JSON payloads: accept / quarantine split.

Each payload is parsed once into a VARIANT; every rule is a native
expression producing an optional violation string, collected into a
``violations array<string>`` column.  Rows with no violation are
accepted, the rest are quarantined with their reasons -- a narrow,
map-only job (no shuffle) whatever the table size.

Typing follows the lax rules of the source contract: an int field
accepts JSON integers, integral numbers and integer strings; a float
field accepts numbers and numeric strings; a bool field accepts
booleans, 0/1 and the usual words.  Booleans are not accepted as
numbers (stricter than the source, documented).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

STR, INT, FLOAT, BOOL = "str", "int", "float", "bool"

# Field lists of the two contracts, in the source order.
MODEL_FEATURES = (
    "room_type", "property_type", "neighbourhood_name", "accommodates", "bedrooms", "beds",
    "bathrooms", "listing_price", "minimum_nights", "maximum_nights", "instant_bookable",
    "host_is_superhost", "host_listing_count", "total_reviews_before_cutoff",
    "unique_reviewers_before_cutoff", "avg_comment_len_before_cutoff",
    "max_comment_len_before_cutoff", "days_since_last_review", "available_days_last_90d",
    "available_rate_last_90d", "avg_minimum_nights_calendar_last_90d",
    "avg_maximum_nights_calendar_last_90d", "available_days_last_30d", "available_rate_last_30d",
    "avg_minimum_nights_calendar_last_30d", "avg_maximum_nights_calendar_last_30d")
FORBIDDEN_FIELDS = ("listing_id", "cutoff_date", "dataset_version",
                    "future_calendar_days_observed_30d", "future_available_days_30d",
                    "future_available_rate_30d", "high_demand_proxy")
BOOL_WORDS = ("true", "false", "t", "f", "yes", "no", "y", "n", "on", "off", "1", "0")


@dataclass(frozen=True)
class FieldRule:
    name: str
    kind: str
    nullable: bool = False
    required: bool = True      # key must be present
    ge: float | None = None
    le: float | None = None


def _w2_rules() -> tuple:
    r = []
    for f in MODEL_FEATURES:
        if f in ("room_type", "property_type", "neighbourhood_name"):
            r.append(FieldRule(f, STR))
        elif f in ("instant_bookable", "host_is_superhost"):
            r.append(FieldRule(f, BOOL))
        elif f in ("accommodates", "minimum_nights", "maximum_nights", "host_listing_count",
                   "available_days_last_90d", "available_days_last_30d"):
            r.append(FieldRule(f, INT, ge=0))
        elif f.startswith("available_rate"):
            r.append(FieldRule(f, FLOAT, ge=0, le=1))
        else:
            r.append(FieldRule(f, FLOAT, nullable=True, ge=0))
    return tuple(r)


def _w3_rules() -> tuple:
    """Second rule set: no ranges, optional fields may be omitted, ``is_superhost``."""
    optional = {"bedrooms", "beds", "bathrooms", "avg_comment_len_before_cutoff",
                "max_comment_len_before_cutoff", "days_since_last_review",
                "avg_minimum_nights_calendar_last_90d", "avg_maximum_nights_calendar_last_90d",
                "avg_minimum_nights_calendar_last_30d", "avg_maximum_nights_calendar_last_30d"}
    r = []
    for f in MODEL_FEATURES:
        name = "is_superhost" if f == "host_is_superhost" else f
        if f in ("room_type", "property_type", "neighbourhood_name"):
            r.append(FieldRule(name, STR))
        elif f in ("instant_bookable", "host_is_superhost"):
            r.append(FieldRule(name, BOOL))
        elif f in ("accommodates", "minimum_nights", "maximum_nights"):
            r.append(FieldRule(name, INT))
        elif f in optional:
            r.append(FieldRule(name, FLOAT, nullable=True, required=False))
        else:
            r.append(FieldRule(name, FLOAT))
    return tuple(r)


W2_RULES = _w2_rules()
W3_RULES = _w3_rules()


def _kind_of(t: Column) -> Column:
    """Map ``schema_of_variant`` names to str/int/num/bool/null."""
    return (F.when(t.isNull(), F.lit("absent"))
             .when(t == "VOID", F.lit("null"))
             .when(t == "STRING", F.lit("str"))
             .when(t == "BOOLEAN", F.lit("bool"))
             .when(t.isin("BIGINT", "INT", "SMALLINT", "TINYINT"), F.lit("int"))
             .when(t.startswith("DECIMAL") | t.isin("DOUBLE", "FLOAT"), F.lit("num"))
             .otherwise(F.lit("other")))


#: texts that are numbers: digits with an optional point and exponent, no NaN, no suffix letters
NUMBER = r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def number(text: Column) -> Column:
    """A numeric text as double; null for any other text."""
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def clean_for_json(df: DataFrame) -> DataFrame:
    """PF20: NaN becomes null, which JSON has, in every floating column."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select(*(F.when(~F.isnan(F.col(f"`{c}`")), F.col(f"`{c}`")).alias(c) if c in floats else F.col(f"`{c}`") for c in df.columns))


def _rule_violations(vals: Column, keys: Column, pv: Column, rule: FieldRule) -> list[Column]:
    """Violation strings of one field.

    ``vals`` holds every field as its raw JSON text (strings unquoted), so
    numeric / boolean rules are plain string casts; only text fields need
    the JSON type (a number is not a string), read from the variant.
    """
    present = F.array_contains(keys, F.lit(rule.name))
    raw = vals[rule.name]
    is_null = present & raw.isNull()
    num = number(F.trim(raw))
    if rule.kind == STR:
        type_ok = _kind_of(F.schema_of_variant(F.variant_get(pv, f"$.{rule.name}", "variant"))) == "str"
        val = None
    elif rule.kind == INT:
        type_ok = num.isNotNull() & (num == F.floor(num))
        val = num
    elif rule.kind == FLOAT:
        type_ok = num.isNotNull()
        val = num
    else:
        type_ok = F.lower(F.trim(raw)).isin(*BOOL_WORDS)
        val = None
    out = [
        F.when(~present & F.lit(rule.required), F.lit(f"missing:{rule.name}")),
        F.when(is_null & F.lit(not rule.nullable), F.lit(f"null:{rule.name}")),
        F.when(present & ~is_null & ~F.coalesce(type_ok, F.lit(False)), F.lit(f"type:{rule.name}")),
    ]
    if val is not None and (rule.ge is not None or rule.le is not None):
        bad = F.lit(False)
        if rule.ge is not None:
            bad = bad | (val < F.lit(rule.ge))
        if rule.le is not None:
            bad = bad | (val > F.lit(rule.le))
        out.append(F.when(present & ~is_null & type_ok & bad, F.lit(f"range:{rule.name}")))
    return out


def _raw_schema(rules) -> str:
    return "struct<" + ",".join(f"`{r.name}`:string" for r in rules) + ">"


def with_violations(df: DataFrame, payload: str = "payload", rules=W2_RULES,
                    forbidden=FORBIDDEN_FIELDS, forbid_extra: bool = True) -> DataFrame:
    """PF18/PF19: add ``violations`` (sorted array<string>, empty = accepted).

    The payload is parsed a fixed number of times per row (field texts,
    key list, one variant for the text-type checks).  The parsed values
    come out of a generator (``inline``), which the optimizer does not
    inline into later expressions or pushed-down filters, so each parse
    runs once and every rule above it is a cheap, code-generated
    expression over plain columns.
    """
    p = F.col(payload)
    parsed = df.select("*", F.inline(F.array(F.struct(
        F.from_json(p, _raw_schema(rules)).alias("_vals"),
        F.coalesce(F.json_object_keys(p), F.array().cast("array<string>")).alias("_keys"),
        F.try_parse_json(p).alias("_pv")))))
    vals, keys, pv = F.col("_vals"), F.col("_keys"), F.col("_pv")
    out = []
    for rule in rules:
        out += _rule_violations(vals, keys, pv, rule)
    base = F.filter(F.array(*out), lambda x: x.isNotNull())
    if forbid_extra:
        expected = F.array(*[F.lit(r.name) for r in rules])
        forb = F.array(*[F.lit(f) for f in forbidden])
        extra = F.filter(keys, lambda x: ~F.array_contains(expected, x))
        tagged = F.transform(extra, lambda x: F.when(F.array_contains(forb, x),
                                                     F.concat(F.lit("forbidden:"), x))
                             .otherwise(F.concat(F.lit("unknown:"), x)))
        base = F.array_union(base, tagged)
    v = F.when(pv.isNull(), F.array(F.lit("parse:payload"))).otherwise(F.array_sort(base))
    return parsed.withColumn("violations", v).drop("_vals", "_keys", "_pv")


def contract_split(df: DataFrame, payload: str = "payload", rules=W2_RULES):
    """Accepted / quarantined frames (same plan, one filter each)."""
    v = with_violations(df, payload, rules)
    return v.where(F.size("violations") == 0), v.where(F.size("violations") > 0)


def parse_accepted(accepted: DataFrame, payload: str = "payload", rules=W2_RULES) -> DataFrame:
    """Typed model-input columns from accepted payloads, in contract order.

    The payload is parsed once (bound as a lambda variable) for all fields.
    """
    def typed(pv):
        fields = []
        for r in rules:
            if r.kind == BOOL:
                raw = F.lower(F.trim(F.try_variant_get(pv, f"$.{r.name}", "string")))
                c = F.when(raw.isin("true", "t", "yes", "y", "on", "1"), F.lit(True)) \
                     .when(raw.isin("false", "f", "no", "n", "off", "0"), F.lit(False))
            elif r.kind == STR:
                c = F.try_variant_get(pv, f"$.{r.name}", "string")
            else:
                t = "bigint" if r.kind == INT else "double"
                c = F.try_variant_get(pv, f"$.{r.name}", "double").cast(t)
            fields.append(c.alias(r.name))
        return F.struct(*fields)

    parsed = F.transform(F.array(F.parse_json(F.col(payload))), typed)[0]
    keep = [c for c in accepted.columns if c not in (payload, "violations")]
    return accepted.select(*keep, parsed.alias("_typed")).select(*keep, "_typed.*")


# -- request bounds (PF21) -----------------------------------------------------------------

MAX_QUERY_CHARS = 4096
MIN_TOP_K, MAX_TOP_K = 1, 100
ALLOWED_LANGS = ("en",)
MAX_BATCH_TEXTS = 256


def query_bound_violations(df: DataFrame, query: str = "query", top_k: str = "top_k",
                           lang: str = "lang") -> DataFrame:
    """PF21: bounds of search requests as a ``violations`` column."""
    q = F.col(query)
    checks = F.array(
        F.when(q.isNull() | (F.length(q) < 1), F.lit("query:empty")),
        F.when(F.length(q) > MAX_QUERY_CHARS, F.lit("query:too_long")),
        F.when(F.col(top_k).isNull() | (F.col(top_k) < MIN_TOP_K) | (F.col(top_k) > MAX_TOP_K),
               F.lit("top_k:out_of_range")),
        F.when(F.col(lang).isNotNull() & ~F.col(lang).isin(*ALLOWED_LANGS), F.lit("lang:unsupported")))
    return df.withColumn("violations", F.filter(checks, lambda x: x.isNotNull()))


def batch_bound_violations(df: DataFrame, n_texts: str = "n_texts") -> DataFrame:
    """PF21: a batch holds 1 to ``MAX_BATCH_TEXTS`` texts, told by its size."""
    n = F.coalesce(F.col(n_texts), F.lit(0))
    checks = F.array(F.when(n < 1, F.lit("texts:too_few")), F.when(n > MAX_BATCH_TEXTS, F.lit("texts:too_many")))
    return df.withColumn("violations", F.filter(checks, lambda x: x.isNotNull()))
