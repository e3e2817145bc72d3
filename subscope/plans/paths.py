"""Which channel path precedes which product purchase."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.aggregates import distinct_rollup
from ..functions.columns import clean_id, ladder, paste
from ..operators.groups import keep_group_max, share_of, with_group_stat
from ..operators.joins import match_on_id_and_date
from ..operators.ordered import five_number
from ..operators.reshape import bind_rows, distinct_channels, to_long, to_wide

VISIT = ["visitor_id", "visit_number"]
# Referrer types of the click extract and their column names.
CHANNELS = {
    "missing": "missing",
    "other web sites": "other_web_sites",
    "search engines": "search_engines",
    "social networks": "social_networks",
    "typed/bookmarked": "typed_bookmarked",
}
COUNTS = list(CHANNELS.values())
ACCESS = {0: "anonymous", 1: "reg", 3: "subscribed"}


def _position() -> Column:
    """Where a hit stands in its user's path."""
    return F.struct("hit_date", "visit_number", "clicks_to_page", "event_id")


def purchasers(hits: DataFrame) -> DataFrame:
    """Hits of users with an order.

    A visit belongs to the highest id seen in it, or to its visitor when no id
    was seen.
    """
    rows = hits.withColumn("__uid", clean_id("uid_raw"))
    rows = with_group_stat(rows, VISIT, {"__max": F.max("__uid")})
    rows = rows.withColumn("uid", F.coalesce("__max", "visitor_id")).drop("__uid", "__max")
    buyers = rows.where("orders = 1").select(F.col("uid").alias("__buyer")).distinct()
    return rows.join(buyers, rows["uid"] == buyers["__buyer"], "left_semi")


def path_to_purchase(rows: DataFrame, mode: str) -> DataFrame:
    """Each user's hits up to the first or last purchase.

    The purchase's position is an aggregate (a smallest or largest tuple), so
    no window has to sort a user's whole path.
    """
    pick = {"first": F.min, "last": F.max}[mode]
    at = rows.groupBy(F.col("uid").alias("__u")).agg(
        pick(F.when(F.col("purchase_id").isNotNull(), _position())).alias("__at")
    ).where("__at is not null")
    path = rows.join(at, rows["uid"] == at["__u"]).where(_position() <= F.col("__at"))
    return path.withColumn("is_purchase", _position() == F.col("__at")).drop("__u", "__at")


def channel_name(c="referrer_type") -> Column:
    return F.coalesce(F.col(c), F.lit("missing"))


def last_touch(path: DataFrame) -> DataFrame:
    """Channel, order and day of the purchase row."""
    return path.where("is_purchase").select(
        "uid", "purchase_id", channel_name().alias("last_touch"),
        F.col("hit_date").alias("purchase_date"),
    ).distinct()


def access_of(c="visitor_access", subscribed: int = 3) -> Column:
    """Anonymous 0, registered 1, subscribed otherwise."""
    v = F.col(c)
    return F.when(v.isNull(), 0).when(v.startswith("reg"), 1).otherwise(subscribed)


def access_level(path: DataFrame) -> DataFrame:
    """Per user: highest access at the entry of a day and channel, and highest overall."""
    entries = path.groupBy("uid", "hit_date", "device", "referrer_type").agg(
        F.min_by(access_of(), _position()).alias("entry"), F.max(access_of()).alias("top")
    )
    return entries.groupBy("uid").agg(
        F.max("entry").alias("entry_level"), F.max("top").alias("access_level")
    )


def channel_counts(path: DataFrame) -> DataFrame:
    """Per user: access, days on the path, and visits per channel.

    Hits shrink to one row per user, day, channel and visit first; the pivot
    has declared columns.
    """
    seen = path.groupBy("uid", "hit_date", channel_name().alias("channel"), *VISIT).agg(
        F.max(access_of()).alias("access")
    )
    per_day = seen.groupBy("uid", "hit_date").agg(
        F.max("access").alias("access"),
        *[F.count(F.when(F.col("channel") == c, 1)).alias(n) for c, n in CHANNELS.items()],
    )
    return per_day.groupBy("uid").agg(
        F.max("access").alias("access_level"), F.count(F.lit(1)).alias("total_days"),
        *[F.sum(n).alias(n) for n in COUNTS],
    )


def daily_channel_wide(path: DataFrame) -> DataFrame:
    """Visits per user, day and channel as one column per channel (zero where none)."""
    seen = path.select("uid", "hit_date", channel_name().alias("channel"), *VISIT).distinct()
    n = seen.groupBy("uid", "hit_date", "channel").agg(F.count(F.lit(1)).alias("n"))
    wide = to_wide(n, ["uid", "hit_date"], "channel", "n", list(CHANNELS))
    return wide.select("uid", "hit_date", *[
        F.coalesce(F.col(f"`{c}`"), F.lit(0)).alias(n) for c, n in CHANNELS.items()
    ])


def _shift_last_touch(df: DataFrame, by: int) -> DataFrame:
    return df.withColumns({
        n: F.when(F.col("last_touch") == c, F.col(n) + by).otherwise(F.col(n))
        for c, n in CHANNELS.items()
    })


def prior_channel_counts(counts: DataFrame, touch: DataFrame) -> DataFrame:
    """Channel counts without the purchase visit itself."""
    return _shift_last_touch(counts.join(touch, "uid"), -1)


def order_product(
    codes: DataFrame, singles: Mapping[str, str], bundle: str, other: str,
    split_terms: bool = False,
) -> DataFrame:
    """Product of an order from its codes: exactly two codes are a bundle, one names it."""
    per_order = codes.groupBy("ordernumber").agg(
        F.count_distinct("publicationcode").alias("n"),
        F.max("publicationcode").alias("code"),
        F.min("og_termlength").alias("weeks"),
    )
    steps = [(F.col("n") == 2, bundle)]
    steps += [((F.col("n") == 1) & (F.col("code") == c), p) for c, p in singles.items()]
    product = ladder(steps, other)
    if split_terms:
        term = F.when(F.col("weeks") <= 4, "monthly").otherwise("annual")
        product = F.concat_ws("_", product, term)
    return per_order.select("ordernumber", product.alias("product"))


def order_product_new(
    touch: DataFrame, orders: DataFrame, products: Mapping[str, tuple[str, int]]
) -> DataFrame:
    """Product of purchases found in the new system by customer and day; top level kept.

    ``orders`` has customer, order_day and pubcode; ``products`` maps a code to
    its product and level.
    """
    hits = match_on_id_and_date(
        touch, orders.select("customer", "order_day", "pubcode").distinct(),
        ("uid", "customer"), ("purchase_date", "order_day"),
    )
    code = F.col("pubcode")
    hits = hits.withColumn("level", ladder([(code == c, lv) for c, (_, lv) in products.items()]))
    hits = hits.withColumn("product", ladder([(code == c, p) for c, (p, _) in products.items()]))
    return keep_group_max(hits, ["uid"], "level").select(
        "uid", "purchase_id", "product"
    ).distinct()


def model_rows(
    path: DataFrame, products: DataFrame, new_products: DataFrame | None = None,
    prior: bool = True, merge: Mapping[str, str] | None = None,
) -> DataFrame:
    """One row per purchase: access, days, channel counts, last touch, product.

    Purchases the old system does not know are looked up in the new one.
    ``merge`` maps one product class onto another.
    """
    touch = last_touch(path).drop("purchase_date")
    counts = channel_counts(path)
    rows = prior_channel_counts(counts, touch) if prior else counts.join(touch, "uid")
    old = rows.join(products, rows["purchase_id"] == products["ordernumber"]).drop("ordernumber")
    out = old
    if new_products is not None:
        known = products.select("ordernumber").distinct()
        rest = rows.join(known, rows["purchase_id"] == known["ordernumber"], "left_anti")
        out = bind_rows(old, rest.join(new_products, ["uid", "purchase_id"]))
    product = F.col("product")
    if merge:
        product = ladder([(product == a, b) for a, b in merge.items()], product)
    access = ladder([(F.col("access_level") == k, v) for k, v in ACCESS.items()])
    return out.select(
        "uid", "purchase_id", access.alias("access"), "total_days", *COUNTS, "last_touch",
        product.alias("product"),
    )


# --- reports over the purchase rows ----------------------------------------------------


def with_channel_segment(rows: DataFrame, prior: bool = True) -> DataFrame:
    """The single channel of a path, or Multi-channel; the purchase visit counts."""
    full = _shift_last_touch(rows, 1) if prior else rows
    used = F.array_compact(F.array(*[
        F.when(F.col(n) > 0, F.lit(n)) for n in COUNTS
    ]))
    seg = F.when(F.size("__used") == 0, "missing").when(
        F.size("__used") == 1, F.get("__used", F.lit(0))
    ).otherwise("Multi-channel")
    marked = full.withColumn("__used", used).withColumn("channel_segment", seg)
    return marked.drop("__used")


def day_bucket(c="total_days") -> Column:
    d = F.col(c)
    return F.when(d == 1, "One Day").when(d <= 5, "2 - 5 Days").otherwise("6 Days +")


def product_share_by(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """Distinct purchasers per product, as a share of the group."""
    n = distinct_rollup(rows, [*by, "product"], ["uid"])
    return share_of(n, by, "n")


def product_by_touch(rows: DataFrame) -> DataFrame:
    return product_share_by(rows, ["last_touch", "access"])


def product_by_segment(rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return product_share_by(with_channel_segment(rows), ["channel_segment", *by])


def days_to_order(rows: DataFrame) -> DataFrame:
    """Days to purchase by channel segment and product: mean and five numbers."""
    return five_number(with_channel_segment(rows), ["channel_segment", "product"], "total_days")


def product_by_day_bucket(rows: DataFrame) -> DataFrame:
    return product_share_by(rows.withColumn("day_bucket", day_bucket()), ["access", "day_bucket"])


def product_share(rows: DataFrame) -> DataFrame:
    return product_share_by(rows, [])


def combo_share(rows: DataFrame) -> DataFrame:
    """Product share by channel segment and last touch together (rows, not users)."""
    marked = with_channel_segment(rows)
    n = marked.groupBy(paste(["channel_segment", "last_touch"], "-").alias("combo"),
                       "product").agg(F.count(F.lit(1)).alias("n"))
    return share_of(n, ["combo"], "n")


# --- reports over scored rows (uid, predictors, category, probability) ---------------------


def score_by_distinct_channels(scores: DataFrame) -> DataFrame:
    """Mean probability by number of channels used, last touch and access."""
    full = _shift_last_touch(scores, 1)
    ids = ["uid", "purchase_id", "category"]
    n = distinct_channels(full, ids, COUNTS, "n_channels")
    rows = scores.select(*ids, "last_touch", "access", "probability").join(n, ids)
    return rows.groupBy("category", "last_touch", "access", "n_channels").agg(
        F.avg("probability").alias("mean_probability")
    )


def score_by_segment(scores: DataFrame) -> DataFrame:
    rows = with_channel_segment(scores).withColumn("day_bucket", day_bucket())
    return rows.groupBy("channel_segment", "day_bucket", "access", "category").agg(
        F.avg("probability").alias("mean_probability")
    )


def score_by_visit_count(scores: DataFrame) -> DataFrame:
    """Mean probability by channel and number of earlier visits through it."""
    long = to_long(
        scores.select("last_touch", "category", "probability", *COUNTS),
        ["last_touch", "category", "probability"], COUNTS, "channel", "visit_count",
    )
    return long.groupBy("last_touch", "category", "channel", "visit_count").agg(
        F.avg("probability").alias("mean_probability")
    )
