"""Queries over masks, row access and classification."""

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import operators as O
from ..operators.governance import match_ratios
from ..plans import adapters as A
from ..plans.customers import customer_overview
from ..sources.files import table
from .common import plain, stored

# The roles of the policies, and one that no policy names.
ROLES = (
    "CLIENT_ADVISOR_RL",
    "BUSINESS_ANALYST_RL",
    "DATA_ENGINEER_RL",
    "DATA_STEWARD",
    "FISERV_ADMIN",
    "SYSADMIN",
)

ADVISOR = O.Principal("ADV0", "CLIENT_ADVISOR_RL")

CUSTOMER_TAGS = {
    "first_name": "PII_MODERATE",
    "last_name": "PII_MODERATE",
    "birthdate": "PII_LOW",
    "age": "PII_LOW",
    "street_address": "PII_MODERATE",
    "phone_number": "PII_MODERATE",
    "ssn": "PII_HIGH",
    "retirement_age": "PII_LOW",
}


def _per_role(df: DataFrame, view: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """What each role sees, one below the other, of one stored table."""
    df = stored(df.sparkSession, df, "people")
    seen = [view(df, role).withColumn("role", F.lit(role)) for role in ROLES]
    return reduce(DataFrame.unionByName, seen)


def _masked(column: str, mask: Callable[[Column, str], Column], role: str) -> Column:
    return mask(F.col(column), role).alias(column)


def mask_ssn(spark: SparkSession, folder: str) -> DataFrame:
    return _per_role(
        A.customers(spark, folder),
        lambda df, role: df.select("customer_id", _masked("ssn", O.mask_ssn, role)),
    )


def mask_text(spark: SparkSession, folder: str) -> DataFrame:
    return _per_role(
        A.customers(spark, folder),
        lambda df, role: df.select(
            "customer_id",
            *(_masked(name, O.mask_text, role)
              for name in ("first_name", "last_name", "street_address", "phone_number")),
        ),
    )


def mask_numeric_date(spark: SparkSession, folder: str) -> DataFrame:
    seen = _per_role(
        A.customers(spark, folder),
        lambda df, role: df.select(
            "customer_id",
            _masked("age", O.mask_number, role),
            _masked("birthdate", O.mask_date, role),
        ),
    )
    return plain(seen, ("age",))


def masked_customers(spark: SparkSession, folder: str) -> DataFrame:
    seen = _per_role(
        A.customers(spark, folder), lambda df, role: O.apply_masks(df, CUSTOMER_TAGS, role)
    )
    return plain(seen, ("age", "retirement_age"))


def _own(spark: SparkSession, folder: str, principal: O.Principal) -> DataFrame:
    return O.row_access(
        A.customers(spark, folder),
        principal,
        A.customer_advisor(spark, folder),
        A.advisor_users(spark, folder),
    )


def row_access(spark: SparkSession, folder: str) -> DataFrame:
    """Customers each of four users sees."""
    users = (
        ADVISOR,
        O.Principal("NOBODY", "CLIENT_ADVISOR_RL"),
        O.Principal("ADV0", "BUSINESS_ANALYST_RL"),
        O.Principal("ADV0", "SYSADMIN"),
    )
    seen = [
        _own(spark, folder, who).select(
            "customer_id", F.lit(who.user).alias("username"), F.lit(who.role).alias("role")
        )
        for who in users
    ]
    return reduce(DataFrame.unionByName, seen)


def simulated_overview(spark: SparkSession, folder: str) -> DataFrame:
    def query(who: O.Principal) -> DataFrame:
        visible = O.apply_masks(_own(spark, folder, who), CUSTOMER_TAGS, who.role)
        return customer_overview(
            visible,
            A.customer_portfolio(spark, folder),
            A.portfolios(spark),
            A.retirement_plans(spark, folder),
        ).select(
            "customer_id",
            "first_name",
            "last_name",
            "age",
            "ssn",
            "phone_number",
            "state",
            "customer_type",
            "retirement_stage",
            "personal_wealth_portfolio",
            "retirement_fund",
        ).orderBy("age", "customer_id")

    return plain(O.as_principal(ADVISOR, query))


def governed_overview(spark: SparkSession, folder: str) -> DataFrame:
    """The overview as an advisor's login sees it in each role, by masks that classification found; no column is named for them."""
    people = stored(spark, A.customers(spark, folder), "people")
    governed = O.govern({"CUSTOMERS": people})
    links, users = A.customer_advisor(spark, folder), A.advisor_users(spark, folder)

    def query(who: O.Principal) -> DataFrame:
        return customer_overview(
            governed.as_seen_by("CUSTOMERS", who, links, users),
            A.customer_portfolio(spark, folder),
            A.portfolios(spark),
            A.retirement_plans(spark, folder),
        ).withColumn("role", F.lit(who.role))

    seen = [O.as_principal(O.Principal(ADVISOR.user, role), query) for role in ROLES]
    return plain(reduce(DataFrame.unionByName, seen), ("age",))


def classify_columns(spark: SparkSession, folder: str) -> DataFrame:
    return O.classify_columns(A.customers(spark, folder))


def text_categories(spark: SparkSession, folder: str) -> DataFrame:
    """Share of documents with an e-mail address, phone number or national id in them."""
    return match_ratios(table(spark, folder, "documents"), "text")


def tag_columns(spark: SparkSession, folder: str) -> DataFrame:
    return O.tag_columns(
        {"CUSTOMERS": A.customers(spark, folder), "ADVISORS": A.advisors(spark, folder)}
    )


QUERIES = {
    "mask_ssn": mask_ssn,
    "mask_text": mask_text,
    "mask_numeric_date": mask_numeric_date,
    "masked_customers": masked_customers,
    "row_access": row_access,
    "simulated_overview": simulated_overview,
    "governed_overview": governed_overview,
    "classify_columns": classify_columns,
    "text_categories": text_categories,
    "tag_columns": tag_columns,
}
