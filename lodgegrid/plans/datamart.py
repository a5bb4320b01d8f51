"""The result sets: 21 stored views and 11 composed ones, by name."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators import best_listing, census as age, hosts, metrics as m
from ..sinks.store import read_version, replace_months, versions, write_version

LGA_MONTH = ["host_lga_cleansed", "year_month"]

# versions of a stored result that stay, so that its readers finish with the one they began
KEPT_VERSIONS = 3


@dataclass(frozen=True)
class Inputs:
    """What views read: typed listings, the area list and the census fact."""

    listings: DataFrame
    lga: DataFrame | None = None
    census: DataFrame | None = None


@dataclass(frozen=True)
class View:
    build: Callable[[Inputs], DataFrame]
    ascending: tuple[str, ...] = ()
    # how to build it from the month summary at ``grain`` instead of the listings
    from_summary: Callable[[DataFrame], DataFrame] | None = None
    grain: tuple[str, ...] = ()
    descending: tuple[str, ...] = ()
    stored: bool = True
    # how to build it in its presentation order, where that is less work than sorting its rows
    in_order: Callable[[Inputs], DataFrame] | None = None

    def ordering(self) -> list[Column]:
        """Missing values sort as the largest."""
        return [F.col(c).desc_nulls_first() for c in self.descending] + [
            F.col(c).asc_nulls_last() for c in self.ascending
        ]


def _family(number: int, keys: list[str]) -> dict[str, View]:
    """The nine metrics at one grain."""
    groups = [k for k in keys if k != m.TIME]
    month_first = (m.TIME, *groups)
    month_last = (*groups, m.TIME)

    def name(metric: int, label: str) -> str:
        return f"question_{number}_{metric}_{label}"

    def summed(order: tuple[str, ...], build, from_summary) -> View:
        return View(build, order, from_summary=from_summary, grain=tuple(keys))

    def change(flag: str, drop_zero: bool) -> View:
        return summed(
            month_last,
            lambda i: m.percentage_change(i.listings, keys, flag, drop_zero=drop_zero),
            lambda s: m.percentage_change_of(s, keys, flag, drop_zero=drop_zero),
        )

    return {
        name(1, "active_listings_rate"): summed(
            month_first,
            lambda i: m.active_rate(i.listings, keys),
            lambda s: m.active_rate_of(s, keys),
        ),
        name(2, "min_max_med_avg"): View(lambda i: m.price_stats(i.listings, keys), month_first),
        name(3, "distinct_hosts"): View(lambda i: m.distinct_hosts(i.listings, keys), month_first),
        name(4, "superhost_rate"): View(lambda i: m.superhost_rate(i.listings, keys), month_first),
        name(5, "active_listing_avg_review_score_rating"): summed(
            month_first,
            lambda i: m.average_rating_active(i.listings, keys),
            lambda s: m.average_rating_of(s, keys),
        ),
        name(6, "percentage_change_for_active_listings"): change("t", drop_zero=number == 2),
        name(7, "percentage_change_for_inactive_listings"): change("f", drop_zero=True),
        name(8, "no_of_stays"): summed(
            month_last,
            lambda i: m.stays(i.listings, keys),
            lambda s: s.select(*keys, "number_of_stays"),
        ),
        name(9, "estimated_revenue_active_listings"): View(
            lambda i: m.revenue(i.listings, keys, dedup=True), month_last
        ),
    }


def _shares(i: Inputs) -> DataFrame:
    return age.age_shares_by_lga(i.listings, i.lga, i.census)


def _one_listing(i: Inputs) -> DataFrame:
    return hosts.mortgage_cover_one_listing(i.listings, i.lga, i.census)


# The names that the results must have.
VIEWS: dict[str, View] = (
    _family(1, m.AREA)
    | _family(2, m.PROPERTY)
    | {
        "question_3_1_distinct_hosts": View(
            lambda i: m.distinct_hosts_by_lga(i.listings, i.lga), tuple(LGA_MONTH)
        ),
        "question_3_2_estimated_revenue_active_listings": View(
            lambda i: m.revenue_by_lga(i.listings, i.lga), tuple(LGA_MONTH)
        ),
        "question_3_3_estimated_revenue_per_host": View(
            lambda i: m.revenue_by_lga(i.listings, i.lga, ("host_id",)),
            ("host_id", *LGA_MONTH),
        ),
        "q4_a_1_revenue_lga_g1": View(_shares, descending=("agg_revenue",), stored=False),
        "q4_a_2_revenue_lga_g1": View(_shares, descending=("agg_revenue",), stored=False),
        "q4_a_3_population_bracket_proportion": View(
            lambda i: age.overall_age_shares(_shares(i)), stored=False
        ),
        "q4_a_4_population_bracket_proportion_average": View(
            lambda i: age.average_share_of_top_lga(_shares(i)), stored=False
        ),
        "q4_b_1_listing_neighbourhood_revenue_prop_room_accomodates": View(
            lambda i: best_listing.revenue_per_kind(i.listings), stored=False
        ),
        "q4_b_2_best_listing_type": View(
            lambda i: best_listing.best_kind_per_area(i.listings), stored=False
        ),
        "q4_c_property_lga_host_lga_listings": View(
            lambda i: hosts.host_area_match(i.listings, i.lga), descending=("total_listings",), stored=False
        ),
        "q4_d_1_hosts_with_one_listing": View(
            lambda i: hosts.hosts_with_one_listing(i.listings), ("host_id",), stored=False
        ),
        "q4_d_2_revenue_cover_mortgage": View(
            lambda i: hosts.mortgage_cover(i.listings, i.lga, i.census),
            descending=("estimated_revenue",),
            stored=False,
            in_order=lambda i: hosts.mortgage_cover_by_revenue(i.listings, i.lga, i.census),
        ),
        "q4_d_3_revenue_cover_mortgage_hosts_with_one_listing": View(_one_listing, stored=False),
        "q4_d_4_cover_count": View(
            lambda i: hosts.mortgage_cover_count_one_listing(i.listings, i.lga, i.census), stored=False
        ),
    }
)


def view(name: str, inputs: Inputs, ordered: bool = False) -> DataFrame:
    """A result by name. ``ordered`` adds its presentation order, one more shuffle."""
    spec = VIEWS[name]
    if ordered and spec.in_order:
        return spec.in_order(inputs)
    result = spec.build(inputs)
    ordering = spec.ordering()
    return result.orderBy(*ordering) if ordered and ordering else result


def stored_views() -> list[str]:
    return [name for name, spec in VIEWS.items() if spec.stored]


def create_stored(inputs: Inputs, folder: str, names: Iterable[str] | None = None) -> None:
    """Store the results that are not stored yet."""
    spark = inputs.listings.sparkSession
    wanted = list(names or stored_views())
    absent = [name for name in wanted if not versions(spark, f"{folder}/{name}")]
    if absent:
        refresh_stored(inputs, folder, absent)


def _summary_path(folder: str, grain: tuple[str, ...]) -> str:
    return f"{folder}/month_summary_{'_'.join(grain)}"


def _store(result: DataFrame, path: str) -> None:
    write_version(result, path, KEPT_VERSIONS)


def refresh_stored(inputs: Inputs, folder: str, names: Iterable[str] | None = None) -> None:
    """Recompute stored results; each replaces its old version once it is complete.

    Results of one grain that can come from its month summary share one pass over the
    listings. The summary is stored too.
    """
    spark = inputs.listings.sparkSession
    wanted = list(names or stored_views())
    for grain in dict.fromkeys(VIEWS[name].grain for name in wanted if VIEWS[name].grain):
        _store(m.month_summary(inputs.listings, list(grain)), _summary_path(folder, grain))
    for name in wanted:
        spec = VIEWS[name]
        if spec.grain:
            result = spec.from_summary(read_version(spark, _summary_path(folder, spec.grain)))
        else:
            result = spec.build(inputs)
        _store(result, f"{folder}/{name}")


def monthly_views() -> list[str]:
    """Stored results whose rows of a month depend on that month's listings alone."""
    return [n for n in stored_views() if "percentage_change" not in n]


def refresh_stored_months(
    inputs: Inputs, folder: str, months: list[int], names: Iterable[str] | None = None
) -> None:
    """Bring stored results up to date with the given months, reading only their listings.

    The months' part of each grain's summary is computed once and replaced first. Results
    of a month alone get that month anew; the ones that look across months are built again
    from the summary.
    """
    spark = inputs.listings.sparkSession
    changed = Inputs(inputs.listings.filter(F.col(m.TIME).isin(months)), inputs.lga, inputs.census)
    wanted = list(names or stored_views())
    for grain in dict.fromkeys(VIEWS[name].grain for name in wanted if VIEWS[name].grain):
        new = m.month_summary(changed.listings, list(grain))
        replace_months(new, _summary_path(folder, grain), months, KEPT_VERSIONS)
    for name in wanted:
        spec, path = VIEWS[name], f"{folder}/{name}"
        if not spec.grain:
            replace_months(spec.build(changed), path, months, KEPT_VERSIONS)
            continue
        summary = read_version(spark, _summary_path(folder, spec.grain))
        if name in monthly_views():
            part = spec.from_summary(summary.filter(F.col(m.TIME).isin(months)))
            replace_months(part, path, months, KEPT_VERSIONS)
        else:
            _store(spec.from_summary(summary), path)


def register_views(inputs: Inputs, names: Iterable[str] | None = None) -> None:
    """Make results queryable by name in SQL; they are computed when queried."""
    for name in names or VIEWS:
        view(name, inputs).createOrReplaceTempView(name)


def read_stored(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_version(spark, f"{folder}/{name}")
