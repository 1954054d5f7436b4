"""Business aggregates over transactions.

Each one groups the facts first and joins names afterwards: partial sums shrink a
hot merchant before the shuffle, and the join then sees one row per group.
A transaction frame has transaction_id, amount, status, merchant_id, customer_id,
transaction_date and payment_method.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paylens.functions.numeric import (
    compliance_flag,
    count_when,
    fee_rate,
    mean_of,
    merchant_tier,
    pct,
    ratio,
    spend_segment,
    total,
    when_sum,
)
from paylens.operators.dedup import latest_per_key


def is_completed() -> Column:
    return F.col("status") == "COMPLETED"


def is_failed() -> Column:
    return F.col("status") == "FAILED"


def the_amount() -> Column:
    return F.col("amount")


def row_count() -> Column:
    return F.count(F.lit(1))


def mean_rate(column: str) -> Column:
    """Mean of rates of two places, summed exactly: the same whatever order rows arrive in."""
    return mean_of(total(F.col(column).cast("decimal(18,2)")), F.count(column))


def totals(txn: DataFrame) -> DataFrame:
    return txn.agg(
        row_count().alias("total_transactions"),
        count_when(is_failed()).alias("failed_count"),
        when_sum(is_completed(), the_amount()).alias("total_revenue"),
    )


def merchant_mart(txn: DataFrame, dim: DataFrame, keep_idle: bool = False) -> DataFrame:
    """Merchant KPIs over finished transactions, in one pass.

    ``keep_idle`` starts from the dimension and shows merchants without transactions
    with zeros; otherwise they are absent.
    """
    facts = (
        txn.where(F.col("status").isin("COMPLETED", "FAILED"))
        .groupBy("merchant_id")
        .agg(
            F.count("transaction_id").alias("total_transactions"),
            count_when(is_failed()).alias("failed_count"),
            F.count_distinct("customer_id").alias("unique_customers"),
            when_sum(is_completed(), the_amount()).alias("total_revenue"),
            count_when(is_completed()).alias("completed_count"),
        )
    )
    joined = dim.join(facts, "merchant_id", "left" if keep_idle else "inner")
    avg_value = mean_of(F.col("total_revenue"), F.col("completed_count"))
    failure = F.round(ratio(F.col("failed_count"), F.col("total_transactions")) * 100, 4)
    out = joined.select(
        "merchant_id", "merchant_name", "category", "city",
        "total_transactions", "failed_count", failure.alias("failure_rate_pct"),
        "total_revenue", avg_value.alias("avg_transaction_value"), "unique_customers",
    )
    if not keep_idle:
        return out
    counts = ["total_transactions", "failed_count", "unique_customers"]
    return out.fillna(0, counts).fillna(0.0, ["failure_rate_pct", "total_revenue", "avg_transaction_value"])


def merchant_performance(txn: DataFrame, dim: DataFrame | None = None, daily: bool = False) -> DataFrame:
    """Revenue, count and failure rate per merchant over all statuses.

    Unmatched merchants stay, with blank names. With ``dim`` the names come from a join
    after the grouping; without it ``txn`` carries them already.
    """
    keys = ["merchant_id"] + (["transaction_date"] if daily else [])
    names = ["merchant_name", "category", "city"]
    measures = [
        when_sum(is_completed(), the_amount()).alias("total_revenue"),
        row_count().alias("txn_count"),
        pct(count_when(is_failed()), row_count()).alias("failure_rate_pct"),
    ]
    if dim is None:
        return txn.groupBy(*keys).agg(*[F.max(c).alias(c) for c in names], *measures).fillna("", names)
    return txn.groupBy(*keys).agg(*measures).join(dim, "merchant_id", "left").fillna("", names)


def daily_summary(silver: DataFrame) -> DataFrame:
    """Sums and distinct customers from sums by day and customer, distinct merchants from a second grouping.

    Two distinct counts in one grouping would copy every row for each of them.
    ``plans.increment`` keeps both as state and reads no Silver again.
    """
    zero = F.lit(0).cast("decimal(18,2)")
    per_customer = silver.groupBy(F.col("transaction_date").alias("report_date"), "customer_id").agg(
        F.sum(F.when(is_completed(), the_amount()).otherwise(zero)).alias("revenue"), row_count().alias("n"), count_when(is_failed()).alias("failed")
    )
    sums = per_customer.groupBy("report_date").agg(
        total(F.col("revenue")).alias("total_revenue"), F.sum("n").alias("total_txns"), F.count("customer_id").alias("unique_customers"),
        pct(F.sum("failed"), F.sum("n")).alias("failure_rate_pct"),
    )
    sold = silver.groupBy("transaction_date", "merchant_id").agg(F.lit(1).alias("one")).groupBy("transaction_date").agg(F.count("merchant_id").alias("unique_merchants"))
    return sums.join(sold, F.col("report_date").eqNullSafe(F.col("transaction_date"))).select(
        "report_date", "total_revenue", "total_txns", "unique_customers", "unique_merchants", "failure_rate_pct"
    )


def customer_ltv(silver: DataFrame) -> DataFrame:
    """Lifetime value per customer with the most used payment method.

    Sums per (customer, method) feed the sums per customer, so the preferred method
    needs neither a second scan nor a self-join. Ties go to the first name.
    """
    per_method = silver.groupBy("customer_id", "payment_method").agg(
        F.sum(F.when(is_completed(), the_amount()).otherwise(F.lit(0).cast("decimal(18,2)"))).alias("spent"),
        row_count().alias("n"),
        count_when(is_completed()).alias("n_completed"),
        F.min("transaction_date").alias("first_date"),
        F.max("transaction_date").alias("last_date"),
    )
    return per_method.groupBy("customer_id").agg(
        total(F.col("spent")).alias("total_spent"),
        F.sum("n").alias("total_txns"),
        mean_of(total(F.col("spent")), F.sum("n_completed")).alias("avg_txn_value"),
        F.min("first_date").alias("first_txn_date"),
        F.max("last_date").alias("last_txn_date"),
        F.min(F.struct(-F.col("n"), F.col("payment_method"))).getField("payment_method").alias(
            "preferred_payment_method"
        ),
    )


def mode_per_key(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Most frequent value per key, the smallest of equals."""
    counts = df.where(F.col(column).isNotNull()).groupBy(*keys, column).agg(row_count().alias("n"))
    return latest_per_key(counts, keys, [F.desc("n"), F.asc(column)])


def revenue_ranking(txn: DataFrame, dim: DataFrame, n: int | None = None) -> DataFrame:
    per = txn.groupBy("merchant_id").agg(when_sum(is_completed(), the_amount()).alias("revenue_usd"))
    out = per.join(dim, "merchant_id").select("merchant_name", "revenue_usd")
    ranked = out.orderBy(F.desc("revenue_usd"), "merchant_name")
    return ranked if n is None else ranked.limit(n)


def failure_by(txn: DataFrame, column: str) -> DataFrame:
    return txn.groupBy(column).agg(
        row_count().alias("total"),
        count_when(is_failed()).alias("failed"),
        pct(count_when(is_failed()), row_count()).alias("failure_rate_pct"),
    )


def merchant_summary(txn: DataFrame, dim: DataFrame) -> DataFrame:
    per = txn.groupBy("merchant_id").agg(
        F.count("transaction_id").alias("total_txns"),
        count_when(is_completed()).alias("completed"),
        count_when(is_failed()).alias("failed"),
        pct(count_when(is_failed()), row_count()).alias("failure_rate_pct"),
        when_sum(is_completed(), the_amount()).alias("revenue_usd"),
    )
    return per.join(dim, "merchant_id").select(
        "merchant_name", "category", "total_txns", "completed", "failed", "failure_rate_pct", "revenue_usd"
    )


def customer_spend(txn: DataFrame, dim: DataFrame, above: float) -> DataFrame:
    """Customers whose completed spend exceeds ``above``; the filter runs on sums."""
    spend = (
        txn.where(is_completed())
        .groupBy("customer_id")
        .agg(total(the_amount()).alias("lifetime_value"), F.count("transaction_id").alias("total_orders"))
        .where(F.col("lifetime_value") > above)
    )
    return spend.join(dim, "customer_id").select(
        "customer_id", "customer_name", "tier", "lifetime_value", "total_orders"
    )


def daily_gmv(staged: DataFrame, dim: DataFrame) -> DataFrame:
    """Daily gross value per merchant; merchants outside the dimension drop out."""
    per = staged.groupBy("transaction_date", "merchant_id").agg(
        F.count("transaction_id").alias("transaction_count"),
        when_sum(is_completed(), the_amount()).alias("gmv"),
        when_sum(is_failed(), the_amount()).alias("failed_amount"),
        count_when(is_failed()).alias("failed_count"),
        pct(count_when(is_failed()), F.count("transaction_id")).alias("failure_rate_pct"),
    )
    return per.join(dim.select("merchant_id", "merchant_name", "category"), "merchant_id")


def rolling_merchant(gmv: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    """Sums over the last ``days`` days; the rate is the mean of the daily rates."""
    recent = gmv.where(F.col("transaction_date") >= F.date_sub(as_of, days))
    cents = F.col("gmv").cast("decimal(18,2)")
    return recent.groupBy("merchant_id", "merchant_name", "category").agg(
        total(cents).alias("gmv_30d"),
        F.sum("transaction_count").alias("transactions_30d"),
        mean_rate("failure_rate_pct").alias("avg_failure_rate_pct"),
        F.max("transaction_date").alias("last_transaction_date"),
        merchant_tier(F.sum(cents)).alias("merchant_tier"),
    )


def daily_revenue(gmv: DataFrame) -> DataFrame:
    """Sums by day. The first row of a day and merchant counts the merchant.

    A distinct count beside sums would keep all groups of a task in two more hash tables;
    the rows already lie by day and merchant, so a sort is enough.
    """
    cents = F.col("gmv").cast("decimal(18,2)")
    nth = F.row_number().over(Window.partitionBy("transaction_date", "merchant_id").orderBy("merchant_id"))
    return gmv.withColumn("_nth", nth).groupBy("transaction_date").agg(
        total(cents).alias("total_gmv"),
        F.sum("transaction_count").alias("total_transactions"),
        F.count(F.when(F.col("_nth") == 1, F.col("merchant_id"))).alias("active_merchants"),
        total(F.col("failed_amount").cast("decimal(18,2)")).alias("total_failed"),
        F.round(mean_rate("failure_rate_pct"), 2).alias("avg_failure_rate_pct"),
    )


def growth_by(txn: DataFrame, column: str, as_of: Column) -> DataFrame:
    """Growth of the month of ``as_of`` over the month before, in percent."""
    this_month = F.date_trunc("month", as_of).cast("date")
    last_month = F.add_months(this_month, -1)
    day = F.col("transaction_date")
    window = txn.where((day >= last_month) & (day < F.add_months(this_month, 1)))
    now = when_sum(day >= this_month, the_amount())
    before = when_sum(day < this_month, the_amount())
    return window.groupBy(column).agg(
        before.alias("previous"),
        now.alias("current"),
        F.coalesce(pct(now - before, before, 4), F.lit(0.0)).alias("growth_percentage"),
    )


def status_rate_top(txn: DataFrame, dim: DataFrame, status: str, n: int) -> DataFrame:
    """Merchants with the highest share of one status over distinct transactions."""
    distinct = txn.select("transaction_id", "status", "merchant_id").distinct()
    per = distinct.groupBy("merchant_id").agg(
        count_when(F.col("status") == status).alias("status_count"),
        F.count_distinct("transaction_id").alias("transaction_count"),
    )
    rated = per.withColumn("rate", F.round(ratio(F.col("status_count"), F.col("transaction_count")), 6))
    return (
        rated.join(dim.select("merchant_id", "merchant_name"), "merchant_id")
        .orderBy(F.desc("rate"), "merchant_id")
        .limit(n)
    )


def rfm(txn: DataFrame, as_of: Column, idle_days: int = 14) -> DataFrame:
    recency = F.datediff(as_of, F.max("transaction_date"))
    return txn.groupBy("customer_id").agg(
        recency.alias("recency_days"),
        row_count().alias("frequency"),
        when_sum(is_completed(), the_amount()).alias("monetary"),
        (recency > idle_days).alias("at_risk"),
    )


def merchant_risk(txn: DataFrame, limit_pct: float = 30.0, enough: int = 30, some: int = 10) -> DataFrame:
    """Failure rate per merchant and day; confidence follows the number of rows."""
    per = txn.groupBy("merchant_id", "transaction_date").agg(
        row_count().alias("txn_count"), pct(count_when(is_failed()), row_count()).alias("failure_rate_pct")
    )
    return per.withColumn("suspicious", F.col("failure_rate_pct") > limit_pct).withColumn(
        "confidence_level",
        F.when(F.col("txn_count") >= enough, "high").when(F.col("txn_count") >= some, "medium").otherwise("low"),
    )


def volume_anomalies(txn: DataFrame, min_count: int, max_avg: float) -> DataFrame:
    """Merchants with many transactions of an unusually low mean amount."""
    per = txn.groupBy("merchant_id").agg(row_count().alias("txn_count"), total(the_amount()).alias("s"))
    return per.select(
        "merchant_id", "txn_count", mean_of(F.col("s"), F.col("txn_count")).alias("avg_amount")
    ).where((F.col("txn_count") > min_count) & (F.col("avg_amount") < max_avg))


def peer_deviation(txn: DataFrame) -> DataFrame:
    """Each merchant's mean against the mean and spread of all merchants' means."""
    per = txn.groupBy("merchant_id").agg(row_count().alias("txn_count"), total(the_amount()).alias("s"))
    means = per.select("merchant_id", "txn_count", mean_of(F.col("s"), F.col("txn_count")).alias("avg_amount"))
    centre = means.agg(F.avg("avg_amount").alias("m")).scalar()
    spread = means.agg(F.stddev_samp("avg_amount").alias("d")).scalar()
    return means.withColumn("z", F.round((F.col("avg_amount") - centre) / F.nullif(spread, F.lit(0.0)), 4))


def segments(txn: DataFrame, as_of: Column, days: int = 30) -> DataFrame:
    recent = txn.where((F.col("transaction_date") > F.date_sub(as_of, days)) & is_completed())
    per = recent.groupBy("customer_id").agg(total(the_amount()).alias("total_spent"), row_count().alias("txn_frequency"))
    return per.withColumn("segment", spend_segment(F.col("total_spent"))).withColumn(
        "segment_updated_date", as_of
    )


def compliance_daily(txn: DataFrame) -> DataFrame:
    """Audit totals per day and method over every status."""
    flagged = txn.withColumn("flag", compliance_flag(the_amount().cast("double")))
    return flagged.groupBy("transaction_date", "payment_method").agg(
        row_count().alias("txn_count"),
        total(the_amount()).alias("total_amount"),
        count_when(F.col("flag") == "requires_review").alias("review_count"),
    )


def fee_analysis(txn: DataFrame) -> DataFrame:
    """Volume, fees and revenue after fees per payment method."""
    rate = fee_rate(F.col("payment_method"))
    per = txn.groupBy("payment_method").agg(
        row_count().alias("txn_volume"), when_sum(is_completed(), the_amount()).alias("gross_revenue")
    )
    return per.select(
        "payment_method", "txn_volume", "gross_revenue",
        F.round(F.col("gross_revenue") * rate, 2).alias("fees"),
        F.round(F.col("gross_revenue") * (1 - rate), 2).alias("effective_revenue"),
    )


def attribution(txn: DataFrame, promotions: DataFrame) -> DataFrame:
    """Revenue, discount cost and return per channel.

    Both sides are summed per customer before the join: a customer with several
    promotions counts once for each, but is one row per channel however busy.
    ``promotions`` has promo_id, customer_id, channel and discount_pct.
    """
    spend = txn.where(is_completed()).groupBy("customer_id").agg(F.sum(the_amount()).alias("spend"))
    offers = promotions.groupBy("customer_id", "channel").agg(row_count().alias("n"), F.sum("discount_pct").alias("discounts"))
    joined = offers.join(spend, "customer_id")
    cost = F.col("spend").cast("double") * F.col("discounts") / 100.0
    per = joined.groupBy("channel").agg(
        total(F.col("spend") * F.col("n")).alias("revenue"),
        F.count_distinct("customer_id").alias("customers"),
        F.round(F.sum(cost), 2).alias("discount_cost"),
    )
    return per.withColumn(
        "roi", F.round(ratio(F.col("revenue") - F.col("discount_cost"), F.col("discount_cost")), 4)
    )


def coverage(items: DataFrame, key: str, item: str, core: Sequence[str], extra: Sequence[str]) -> DataFrame:
    """Tier per entity by which required items it has.

    Distinct items are only counted, never gathered: each wanted item is one
    conditional maximum.
    """
    def has(names: Sequence[str]) -> Column:
        n = F.lit(0)
        for name in names:
            n = n + F.max(F.when(F.col(item) == name, 1).otherwise(0))
        return n

    per = items.groupBy(key).agg(has(core).alias("core_done"), has(extra).alias("extra_done"))
    tier = (
        F.when((F.col("core_done") == len(core)) & (F.col("extra_done") == len(extra)), "master")
        .when(F.col("core_done") == len(core), "complete")
        .when(F.col("core_done") + F.col("extra_done") > 0, "partial")
        .otherwise("missing")
    )
    return per.withColumn("tier", tier)


def tier_rank(tier: Column) -> Column:
    return F.when(tier == "master", 0).when(tier == "complete", 1).when(tier == "partial", 2).otherwise(3)


def golden_metrics(gold: DataFrame) -> DataFrame:
    """Headline numbers of a merchant table, with the merchant of the highest rate."""
    best = F.min(F.struct(-F.col("failure_rate_pct"), F.col("merchant_name")))
    return gold.agg(
        F.count_distinct("merchant_id").alias("total_merchants"),
        total(F.col("total_revenue").cast("decimal(28,2)")).alias("total_revenue"),
        F.round(mean_rate("failure_rate_pct"), 2).alias("avg_failure_rate"),
        F.max("failure_rate_pct").alias("max_failure_rate"),
        best.getField("merchant_name").alias("merchant_max_fail"),
    )


#: Bits of a value that one pass over the values settles.
MEDIAN_BITS = 16


def exact_median(df: DataFrame, value: Column) -> DataFrame:
    """Exact median of an exact number (integer or decimal of at most 18 digits) by refining a histogram.

    The values are written once, as whole numbers above the least. A pass counts them by
    their next 16 bits, in at most 65,536 counts that are added up before the shuffle, and
    keeps the bucket that holds the middle; the span of the values decides how many passes
    it takes, four at most. Values themselves are never sorted or moved. An even number of
    values has two middles, which may part in some pass and are followed each.
    """
    from decimal import Decimal

    from paylens.session import written

    number = df.select(value.alias("v")).where("v IS NOT NULL")
    kind = number.schema["v"].dataType
    scale = getattr(kind, "scale", 0)
    if kind.typeName() not in ("byte", "short", "integer", "long", "decimal") or getattr(kind, "precision", 18) > 18:
        raise ValueError(f"{kind.simpleString()} is no exact number of 18 digits")
    whole = written(number.select((F.col("v").cast(f"decimal(38,{scale})") * 10**scale).cast("long").alias("v")), "median-values")
    size, low, high = whole.agg(row_count(), F.min("v"), F.max("v")).first()
    result = "median double"
    if not size:
        return df.sparkSession.createDataFrame([(None,)], result)

    def settle(offset: int, bits: int, ranks: list[int]) -> list[int]:
        """Values at ``ranks`` (from 1) among those that start at ``offset`` and have ``bits`` open bits."""
        if not bits:
            return [offset] * len(ranks)
        step = max(0, bits - MEDIAN_BITS)
        mine = whole.where((F.col("v") >= offset) & (F.col("v") <= min(offset + (1 << bits) - 1, high)))
        counts = mine.groupBy(F.shiftright(F.col("v") - offset, step).alias("b")).agg(row_count().alias("n")).collect()
        found, seen = [], 0
        for bucket, n in sorted((r["b"], r["n"]) for r in counts):
            inside = [r - seen for r in ranks if seen < r <= seen + n]
            if inside:
                found += settle(offset + (bucket << step), step, inside)
            seen += n
        return found

    middles = settle(low, (high - low).bit_length(), [(size + 1) // 2, (size + 2) // 2])
    return df.sparkSession.createDataFrame([(float(Decimal(sum(middles)).scaleb(-scale)) / 2,)], result)


def mean_ranking(txn: DataFrame) -> DataFrame:
    """Mean amount per merchant over positive rows, with the overall total beside it."""
    positive = txn.where(the_amount() > 0)
    per = positive.groupBy("merchant_id").agg(row_count().alias("n"), total(the_amount()).alias("s"))
    overall = per.agg(F.sum(F.col("s").cast("decimal(28,2)")).cast("double")).scalar()
    return per.select(
        "merchant_id", mean_of(F.col("s"), F.col("n")).alias("avg_amount"), overall.alias("total_amount")
    )
