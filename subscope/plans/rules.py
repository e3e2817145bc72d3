"""Brand rules as data: product codes, term buckets, and the stitching variants."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.columns import col, ladder


@dataclass(frozen=True)
class Product:
    code: str
    name: str
    level: int
    exact: bool = True  # otherwise the code may stand anywhere in the text
    rate_upto: float | None = None  # only at this price or below
    rate_is: float | None = None  # only at this price


@dataclass(frozen=True)
class Override:
    """A product only the new system names; its old terms take this name and level."""

    new_product: str
    name: str
    level: int
    code: str | None = None  # only terms with this code


@dataclass(frozen=True)
class Rules:
    """How one brand's contracts are read and stitched.

    ``bridge_dates``: a bridge without a charge reference must also fit the
    contract's dates; otherwise every anchor row of the subscription bridges.
    ``anchor``: the new-system row that continues a contract, by top price or
    by earliest start. The remaining fields pick the brand's way through
    :func:`subscope.plans.history.history`.
    """

    products: tuple[Product, ...]
    monthly_below: int = 8
    annual_from: int | None = None
    autorenew_from: str = "plan"  # or "billing"
    anchor: str = "max_price"  # or "earliest"
    bridge_dates: bool = True
    header: str = "left"  # or "inner"
    liability_pays: str = "amountpaid"  # or "rate"
    override: Override | None = None
    levels: tuple[Product, ...] | None = None  # the level's own ladder where it is not the name's
    other_name: str | None = None  # for codes no step names
    other_level: int | None = None
    merge: str = "rollup"  # or "pairwise", or "line": ``line`` keeps its rows, others roll up
    line: str | None = None
    latest_invoice: bool = False  # one invoice for each subscription and period
    first_bridge: bool = False  # of several bridges the one renewed first
    currency: str | None = None  # its prices count at most ``cap``
    cap: float | None = None
    link: str = "provider"  # or "metadata": where a new subscription names the old one

    def _match(self, p: Product, code: Column, rate) -> Column:
        hit = code == p.code if p.exact else code.contains(p.code)
        if p.rate_upto is not None:
            hit = hit & (col(rate) <= p.rate_upto)
        if p.rate_is is not None:
            hit = hit & (col(rate) == p.rate_is)
        return hit

    def product(self, code, rate="rate") -> Column:
        steps = [(self._match(p, col(code), rate), p.name) for p in self.products]
        return ladder(steps, self.other_name)

    def level(self, code, rate="rate") -> Column:
        steps = [(self._match(p, col(code), rate), p.level) for p in self.levels or self.products]
        return ladder(steps, self.other_level)

    def name_of_level(self, level) -> Column:
        named = [*self.products, *([self.override] if self.override else [])]
        return ladder([(col(level) == p.level, p.name) for p in named])

    def term_bucket(self, weeks) -> Column:
        steps = [(col(weeks) < self.monthly_below, "Monthly")]
        if self.annual_from is None:
            return ladder(steps, "Annual")
        return ladder([*steps, (col(weeks) >= self.annual_from, "Annual")])


# Product codes, names and levels per brand.
BRANDS: dict[str, Rules] = {
    "AN": Rules(
        (
            Product("AN3", "Digital All Access", 3, exact=False),
            Product("AN1", "Premium", 2, exact=False),
            Product("AN2", "Basic Digital", 1),
            Product("AN4", "All Access", 4, exact=False),
        ),
    ),
    "AA": Rules(
        (
            Product("AAZ", "Standard", 1),
            Product("AA", "Premium", 2),
            Product("AAD", "Digital All Access", 4),
        ),
        override=Override("All Access", "All Access", 3, code="AA"),
    ),
    "CD": Rules(
        (Product("CD", "Premium", 2), Product("CDW", "Basic Digital", 1, exact=False)),
        levels=(Product("CDW", "Basic Digital", 1, exact=False),
                Product("CD", "Premium", 2, exact=False)),
        monthly_below=50, annual_from=50, bridge_dates=False, header="inner",
        liability_pays="rate", merge="pairwise", latest_invoice=True,
    ),
    "CN": Rules(
        (
            Product("NHF", "Health Pulse", 3, exact=False),
            Product("CN", "Premium", 2),
            Product("CNW", "Basic Digital", 1, exact=False),
            Product("CND", "All Access", 4, exact=False),
        ),
        levels=(
            Product("CND", "All Access", 4, exact=False),
            Product("NHF", "Health Pulse", 3, exact=False),
            Product("CN", "Premium", 2),
            Product("CNW", "Basic Digital", 1, exact=False),
        ),
        other_name="All Access",
        annual_from=52, anchor="earliest", bridge_dates=False, header="inner",
        merge="line", line="Health Pulse",
    ),
    "CL": Rules(
        (
            Product("CLW", "Basic Digital", 1),
            Product("CL", "Premium", 2, rate_upto=99),
            Product("CL", "All Access", 3, rate_is=499),
        ),
        override=Override("Digital & Data", "Digital & Data", 4),
    ),
    "CB": Rules(
        (
            Product("CB1", "CB1", 1), Product("CB2", "CB2", 2),
            Product("CB3", "CB3", 3), Product("CBH", "CBH", 4),
        ),
        anchor="earliest", bridge_dates=False, link="metadata",
    ),
    "MH": Rules((Product("MHZ", "Digital", 1), Product("MH", "Print", 2)), other_level=3,
                other_name="Health Pulse"),
}
# Two products read the first brand with one more rule each.
BRANDS["AN, earliest bridge"] = replace(
    BRANDS["AN"], anchor="earliest", bridge_dates=False, first_bridge=True)
BRANDS["AN, Canada"] = replace(BRANDS["AN"], bridge_dates=False, currency="CAD", cap=40)


def old_autorenew(policy) -> Column:
    """Renewal policies A and C renew by themselves."""
    return F.when(col(policy).isin("A", "C"), "Y").otherwise("N")


def new_autorenew(plan_flag, billing, source: str) -> Column:
    if source == "plan":
        return F.when(col(plan_flag).isNull(), "N").otherwise("Y")
    bill = col(billing)
    return ladder(
        [
            (bill.contains("charge"), "Y"),
            (bill.contains("send"), "N"),
            (bill.isNull() & col(plan_flag).isNull(), "N"),
        ],
        "Y",
    )


def donor_type() -> Column:
    """First matching flag wins; group when none is set."""
    # Flag column to donor code.
    flags = (("iscorporate", "B"), ("isagency", "A"), ("iscomp", "C"), ("isgiftdonor", "D"),
             ("isindividual", "I"))
    return ladder([(F.col(f).eqNullSafe(True), code) for f, code in flags], "G")
