"""Customer overview and portfolio composition."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..types import COMPOSITION


def customer_overview(
    customers: DataFrame,
    customer_portfolio: DataFrame,
    portfolios: DataFrame,
    retirement_plans: DataFrame,
) -> DataFrame:
    """One row per customer and active portfolio, with the retirement stage."""
    active = customer_portfolio.where("active").select("customer_id", "portfolio_id")
    named = portfolios.select(
        "portfolio_id", F.col("portfolio_description").alias("personal_wealth_portfolio")
    )
    plans = retirement_plans.select(
        "customer_id",
        "years_to_fund_target",
        "retirement_year",
        F.col("assigned_fund_name").alias("retirement_fund"),
    )
    # The stages and the years to the target that they begin at.
    years = F.col("years_to_fund_target")
    stage = (
        F.when(F.col("retired"), "Retired")
        .when(years <= 5, "Near Retirement")
        .when(years <= 15, "Mid Career")
        .otherwise("Early Career")
    )
    return (
        customers.join(active, "customer_id", "left")
        .join(named, "portfolio_id", "left")
        .join(plans, "customer_id", "left")
        .select(
            "customer_id",
            "customer_type",
            "first_name",
            "last_name",
            "age",
            "birthdate",
            "retirement_date",
            "retired",
            "state",
            "phone_number",
            "ssn",
            "job_title",
            "salary",
            stage.alias("retirement_stage"),
            "retirement_year",
            "retirement_fund",
            F.col("risk_level_description").alias("risk_level"),
            "personal_wealth_portfolio",
        )
    )


def composition_unnest(portfolios: DataFrame, asset_classes: DataFrame) -> DataFrame:
    """Asset classes of each portfolio with their weights, from the JSON text."""
    parts = portfolios.select(
        "portfolio_id",
        "portfolio_description",
        F.inline(F.from_json("asset_class_composition", COMPOSITION)["composition"]),
    )
    return parts.join(
        asset_classes.select("asset_class_hash", "asset_class_description"), "asset_class_hash", "left"
    )
