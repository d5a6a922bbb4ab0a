"""Classification, tags, masks and row access.

Role and user are ordinary arguments.  A policy is decided on the driver, before
planning, so a query carries one plain expression per column and no role test.
Order matters: row access first, then masks, then everything else, so that views
and sort orders see masked values.
"""

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import mask_social

# Roles, the redaction text, and who sees what.
ADVISOR = "CLIENT_ADVISOR_RL"
ANALYST = "BUSINESS_ANALYST_RL"
ENGINEER = "DATA_ENGINEER_RL"
STEWARD = "DATA_STEWARD"
ADMIN = "FISERV_ADMIN"
REDACTED = "*** Redacted ***"
BACK_OFFICE = (ENGINEER, STEWARD, ADMIN)

# Semantic category -> privacy category.
PRIVACY = {
    "NAME": "IDENTIFIER",
    "STREET_ADDRESS": "IDENTIFIER",
    "PHONE_NUMBER": "IDENTIFIER",
    "NATIONAL_IDENTIFIER": "IDENTIFIER",
    "EMAIL": "IDENTIFIER",
    "AGE": "QUASI_IDENTIFIER",
    "ADMINISTRATIVE_AREA_1": "QUASI_IDENTIFIER",
    "POSTAL_CODE": "QUASI_IDENTIFIER",
    "COUNTRY": "QUASI_IDENTIFIER",
    "DATE_OF_BIRTH": "QUASI_IDENTIFIER",
    "OCCUPATION": "QUASI_IDENTIFIER",
    "SALARY": "SENSITIVE",
}

# Semantic category -> (tag, tag value).
TAG_MAP = {
    "AGE": ("PII_LOW", "age"),
    "DATE_OF_BIRTH": ("PII_LOW", "date"),
    "NAME": ("PII_MODERATE", "name"),
    "STREET_ADDRESS": ("PII_MODERATE", "address"),
    "PHONE_NUMBER": ("PII_MODERATE", "phone"),
    "NATIONAL_IDENTIFIER": ("PII_HIGH", "social_security_number"),
}


@dataclass(frozen=True)
class Principal:
    """Who is asking."""

    user: str
    role: str


# ---------------------------------------------------------------- masks


def mask_ssn(value: Column, role: str) -> Column:
    """Redacted for most roles, last four digits for advisors.  NULL is redacted too."""
    if role in (ANALYST, *BACK_OFFICE):
        return F.lit(REDACTED)
    return mask_social(value) if role == ADVISOR else value


def mask_text(value: Column, role: str) -> Column:
    """Names, addresses and phone numbers: clear to advisors."""
    return F.lit(REDACTED) if role in (ANALYST, *BACK_OFFICE) else value


def mask_number(value: Column, role: str, kind: str = "bigint") -> Column:
    """Ages: clear to advisors and analysts, NULL to the back office."""
    return F.lit(None).cast(kind) if role in BACK_OFFICE else value


def mask_date(value: Column, role: str) -> Column:
    """Birth dates: as for ages."""
    return mask_number(value, role, "date")


# A tag may carry one policy per column type.
POLICIES: dict[tuple[str, type], Callable[[Column, str], Column]] = {
    ("PII_HIGH", T.StringType): mask_ssn,
    ("PII_MODERATE", T.StringType): mask_text,
    ("PII_LOW", T.LongType): mask_number,
    ("PII_LOW", T.IntegerType): lambda value, role: mask_number(value, role, "int"),
    ("PII_LOW", T.DecimalType): lambda value, role: mask_number(value, role, "decimal(38,0)"),
    ("PII_LOW", T.DateType): mask_date,
}


def apply_masks(df: DataFrame, tags: Mapping[str, str], role: str) -> DataFrame:
    """Mask each tagged column by the policy its tag has for the column's type.

    `tags` maps column names to tags.  A tag without a policy for that type leaves
    the column clear.
    """
    columns = []
    for field in df.schema.fields:
        policy = POLICIES.get((tags.get(field.name, ""), type(field.dataType)))
        value = F.col(field.name)
        columns.append(policy(value, role).alias(field.name) if policy else value)
    return df.select(*columns)


# ---------------------------------------------------------------- rows


def row_access(
    df: DataFrame,
    principal: Principal,
    customer_advisor: DataFrame,
    advisor_users: DataFrame,
    key: str = "customer_id",
) -> DataFrame:
    """Advisors see the customers assigned to them; every other role sees all rows.

    The semi-join cannot duplicate a customer who has two advisors.
    """
    if principal.role != ADVISOR:
        return df
    own = customer_advisor.join(
        advisor_users.where(F.col("username") == principal.user).select("advisor_id"), "advisor_id"
    ).select(F.col("customer_id").alias(key))
    return df.join(own, key, "left_semi")


def as_principal(principal: Principal, query: Callable[[Principal], DataFrame]) -> DataFrame:
    """Run a query as somebody else."""
    return query(principal)


# ---------------------------------------------------------------- classification


@dataclass(frozen=True)
class Rule:
    """How a category is recognised: by value pattern, by column name, or by both."""

    category: str
    hints: tuple[str, ...]
    pattern: str | None = None
    kinds: tuple[type, ...] = (T.StringType,)
    hint_required: bool = False


NUMERIC = (T.IntegerType, T.LongType, T.DecimalType, T.DoubleType)

RULES = (
    Rule("NATIONAL_IDENTIFIER", ("ssn", "national_id"), r"^\d{3}-\d{2}-\d{4}$"),
    Rule(
        "PHONE_NUMBER",
        ("phone",),
        r"^(\+\d{1,2} )?\(?\d{3}\)?[ .-]?\d{3}[.-]\d{4}$",
    ),
    Rule("EMAIL", ("email",), r"^[\w.+-]+@[\w-]+(\.[\w-]+)+$"),
    Rule(
        "POSTAL_CODE",
        ("zip", "postal"),
        r"^\d{5}(-\d{4})?$",
        (T.StringType, T.IntegerType, T.LongType),
        hint_required=True,
    ),
    Rule("STREET_ADDRESS", ("address", "street"), r"^\d+ .+"),
    Rule("NAME", ("first_name", "last_name", "name"), r"^[A-Za-z' -]+$", hint_required=True),
    Rule("ADMINISTRATIVE_AREA_1", ("state",), r"^.+$", hint_required=True),
    Rule("COUNTRY", ("country",), r"^.+$", hint_required=True),
    Rule("OCCUPATION", ("job_title",), r"^.+$", hint_required=True),
    Rule("AGE", ("age",), None, NUMERIC, hint_required=True),
    Rule("SALARY", ("salary",), None, NUMERIC, hint_required=True),
    Rule("DATE_OF_BIRTH", ("birth",), None, (T.DateType,), hint_required=True),
)

# The same shapes anywhere inside a longer text.  Optional leading parts do not matter
# there, and an address is only tried at the start of a word, which keeps the scan linear.
INSIDE = {
    "EMAIL": r"(?<![\w.+-])[\w.+-]++@[\w-]+(\.[\w-]+)+",
    "PHONE_NUMBER": r"\d{3}\)?[ .-]?\d{3}[.-]\d{4}",
    "NATIONAL_IDENTIFIER": r"\d{3}-\d{2}-\d{4}",
}

SURE = 0.8
LIKELY = 0.5


def _hinted(rule: Rule, column: str) -> bool:
    words = column.lower()
    if rule.category in ("AGE", "NAME"):
        # Short words: whole name parts only, so "page" is no age and "company_name" no person.
        return words in rule.hints or words.endswith(tuple(f"_{hint}" for hint in rule.hints)) and (
            rule.category == "AGE"
        )
    return any(hint in words for hint in rule.hints)


def match_ratios(df: DataFrame, column: str, patterns: Mapping[str, str] = INSIDE) -> DataFrame:
    """Share of non-NULL texts in which each pattern occurs, one row per pattern."""
    value = F.col(column)
    shares = [
        F.avg(F.when(value.isNotNull(), value.rlike(pattern).cast("int"))).alias(name)
        for name, pattern in patterns.items()
    ]
    return _unpivot(df.agg(*shares), list(patterns), "semantic_category", "match_ratio")


def _unpivot(row: DataFrame, names: Sequence[str], key: str, value: str) -> DataFrame:
    return row.unpivot([], list(names), key, value).withColumn(value, F.round(F.col(value), 4))


def classify_columns(df: DataFrame) -> DataFrame:
    """Category of each column: (column_name, semantic_category, privacy_category, match_ratio).

    All columns and rules are measured in one pass with one row of sums, so the
    table is read once and next to nothing is shuffled.  A category counts when at
    least 80% of the non-NULL values match, or 50% where the column name hints at
    it as well.  Dates and amounts are told by type and name.  The greatest share
    wins, then the order of the rules.
    """
    tests: list[tuple[str, str, float, int, Column]] = []
    for field in df.schema.fields:
        for rank, rule in enumerate(RULES):
            hinted = _hinted(rule, field.name)
            if not isinstance(field.dataType, rule.kinds) or (rule.hint_required and not hinted):
                continue
            value = F.col(field.name)
            hit = (
                F.lit(1)
                if rule.pattern is None
                else F.trim(value.cast("string")).rlike(rule.pattern).cast("int")
            )
            share = F.avg(F.when(value.isNotNull(), hit))
            tests.append((field.name, rule.category, LIKELY if hinted else SURE, rank, share))
    if not tests:
        raise ValueError("no column has a type that can be classified")
    names = [f"m{place}" for place in range(len(tests))]
    measured = df.agg(*(share.alias(name) for name, (*_, share) in zip(names, tests, strict=True)))
    # One row per column and rule that can apply to it.
    meaning = df.sparkSession.createDataFrame(
        [
            (name, column, category, PRIVACY[category], least, -rank)
            for name, (column, category, least, rank, _) in zip(names, tests, strict=True)
        ],
        "test string, column_name string, semantic_category string, privacy_category string, "
        "least double, rank int",
    )
    return (
        _unpivot(measured, names, "test", "match_ratio")
        .join(F.broadcast(meaning), "test")
        .where(F.col("match_ratio") >= F.col("least"))
        .groupBy("column_name")
        .agg(F.max(F.struct("match_ratio", "rank", "semantic_category", "privacy_category")).alias("best"))
        .select(
            "column_name",
            "best.semantic_category",
            "best.privacy_category",
            "best.match_ratio",
        )
    )


def tag_columns(tables: Mapping[str, DataFrame], pattern: str = "PII%") -> DataFrame:
    """Custom tags of all classified columns, as (object_name, column_name, tag_name, tag_value)."""
    spark = next(iter(tables.values())).sparkSession
    tag_map = spark.createDataFrame(
        [(category, tag, value) for category, (tag, value) in TAG_MAP.items()],
        "semantic_category string, tag_name string, tag_value string",
    )
    found = None
    for name, df in tables.items():
        one = classify_columns(df).select(F.lit(name).alias("object_name"), "column_name", "semantic_category")
        found = one if found is None else found.union(one)
    return (
        found.distinct()
        .join(F.broadcast(tag_map), "semantic_category")
        .where(F.col("tag_name").like(pattern))
        .select("object_name", "column_name", "tag_name", "tag_value")
        .orderBy("object_name", "column_name", "tag_name")
    )


# ---------------------------------------------------------------- classification bound to masks


@dataclass(frozen=True)
class Governed:
    """Tables whose masks follow from what their columns were found to hold.

    `tags` has, per table, the tag of each tagged column.  It is found once, over whole tables, and
    holds an entry per column, so a query's plan has one plain expression per column and no classification.
    """

    tables: Mapping[str, DataFrame]
    tags: Mapping[str, Mapping[str, str]]

    def as_seen_by(
        self, name: str, principal: Principal, customer_advisor: DataFrame, advisor_users: DataFrame, key: str = "customer_id"
    ) -> DataFrame:
        """A table as somebody sees it: their rows, then the masks that the tags have for the columns' types."""
        rows = row_access(self.tables[name], principal, customer_advisor, advisor_users, key)
        return apply_masks(rows, self.tags.get(name, {}), principal.role)


def govern(tables: Mapping[str, DataFrame], pattern: str = "PII%") -> Governed:
    """Classify all columns, tag them, and bind the policies of the tags; no table has a list of its columns.

    A column's category has one tag, so a column is bound to one policy.  Rows that come later are
    masked by the tags found now; govern again when tables change their layout or their content.
    """
    tags: dict[str, dict[str, str]] = {name: {} for name in tables}
    for row in tag_columns(tables, pattern).collect():
        tags[row["object_name"]][row["column_name"]] = row["tag_name"]
    return Governed(dict(tables), tags)
