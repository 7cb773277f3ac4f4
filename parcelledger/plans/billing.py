"""Daily billing: what each delivered or returned waybill is charged and nets."""

from __future__ import annotations

from datetime import date, timedelta
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelledger.functions import (
    Rule,
    amount,
    as_float,
    day_start,
    factor,
    fee,
    first_match,
    local_date,
    rate,
    ratio,
    weight,
)
from parcelledger.functions.columns import ColumnLike, as_column
from parcelledger.functions.money import AMOUNT, FEE, RATE
from parcelledger.functions.time import JAKARTA, utc_bound
from parcelledger.operators import decode, latest_by, lookup, recent, since, tier_lookup
from parcelledger.operators.filters import within_days
from parcelledger.plans import fixed_values as V
from parcelledger.sources.tables import Tables

BILLING_COLUMNS = (
    "waybill_no",
    "pod_date",
    "waybill_source_name",
    "company_name",
    "key_account_name",
    "parent_shipping_client",
    "pod_category",
    "cod_flag",
    "express_type_name",
    "cargo_weight",
    "original_total_shipping_fee",
    "total_shipping_fee",
    "net_shipping_fee",
    "cod_fee",
    "return_shipping_fee",
    "cod_amount",
    "actual_weight",
    "chargeable_weight",
    "sender_name",
)


# --- inputs -----------------------------------------------------------------------------

def active_standard_rates(
    rates: DataFrame, as_of: date, tz: str = JAKARTA, distinct: bool = False
) -> DataFrame:
    """Newest live standard rate per search code."""
    tomorrow = utc_bound(as_of + timedelta(days=1), tz)
    live = rates.filter((F.col("end_expire_time") >= tomorrow) & (F.col("deleted") == "0"))
    shown = [
        "sender_location_id",
        "recipient_location_id",
        "express_type",
        "shipping_client_id",
        "discount_rate",
    ]
    newest = latest_by(live, ["search_code"], "created_at", ties=shown).select(*shown)
    return newest.distinct() if distinct else newest


def wallet_per_waybill(wallet: DataFrame) -> DataFrame:
    """Wallet fees summed to one row per waybill."""
    names = ("total_shipping_fee", "discount_amount", "net_shipping_fee")
    return wallet.groupBy("waybill_no").agg(
        *[F.sum(amount(n)).cast("decimal(18,4)").alias(n) for n in names]
    )


def with_finance_source(
    df: DataFrame,
    mapping: DataFrame,
    source_name: ColumnLike,
    client: ColumnLike,
    is_seller: Column,
    take: dict[str, str],
) -> DataFrame:
    """Add mapping columns twice: by source name, and by client for direct sellers.

    ``take`` maps an output stem to a mapping column; the results are ``<stem>_by_source``
    and ``<stem>_by_seller``.
    """
    by_source = mapping.filter(F.col("type_option") == V.WAYBILL_SOURCE)
    by_seller = mapping.filter(F.col("type_option") == V.VIP_SELLER)
    df = lookup(
        df, by_source, {"waybill_source": source_name},
        {f"{stem}_by_source": column for stem, column in take.items()},
    )
    return lookup(
        df, by_seller, {"parent_shipping_cleint": client},
        {f"{stem}_by_seller": column for stem, column in take.items()},
        gate=is_seller,
    )


def non_ecommerce_returns(
    tables: Tables, as_of: date, tz: str = JAKARTA, days: int = 1
) -> DataFrame:
    """Distinct recent returns with a finance category other than e-commerce.

    One of the two categories being something else is enough; a missing one decides nothing.
    """
    fresh = recent(tables["fact_returns"], "return_record_time", days, as_of, tz)
    named = decode(fresh, tables["dim_system_codes"], "order_source", V.WAYBILL_SOURCE, "source_name")
    mapped = with_finance_source(
        named,
        tables["dim_source_finance_mapping"],
        "source_name",
        "parent_client_name",
        F.col("order_source") == V.SOURCE_KEY_ACCOUNT,
        {"category": "finance_source_category"},
    )
    other = (F.col("category_by_source") != V.E_COMMERCE) | (
        F.col("category_by_seller") != V.E_COMMERCE
    )
    return (
        mapped.filter(other)
        .select("return_waybill_no", "waybill_no", amount("return_shipping_fee").alias("return_shipping_fee"))
        .distinct()
    )


# --- rule tables ------------------------------------------------------------------------

def _source(*codes: str) -> Column:
    return F.col("waybill_source").isin(*codes) if len(codes) > 1 else F.col("waybill_source") == codes[0]


def gross_fee_rules() -> list[Rule]:
    return [
        Rule("express card", _source(V.SOURCE_EXPRESS), F.col("card_gross")),
        Rule("crossborder card", _source(V.SOURCE_CROSSBORDER), F.col("card_gross")),
        Rule("wallet", F.col("wallet_waybill").isNotNull(), fee(F.col("wallet_total"))),
    ]


def gross_fee() -> Column:
    return first_match(gross_fee_rules(), fee(F.col("total_fee")))


class Tariff(NamedTuple):
    """One marketplace tariff: a price per weight multiplier and, for some, per kilogram."""

    name: str
    applies: Column
    per_tier: Column
    per_kilo: Column | None = None


def marketplace_tariffs() -> list[Tariff]:
    """Tariffs of the marketplace partner by origin, city tier and service miles."""
    e2e, first, middle, last = (F.col(f"price_{leg}") for leg in ("e2e", "fm", "mm", "lm"))
    step, service = F.col("city_type"), F.col("role_miles")
    inside = F.col("origin_status") == V.ORIGIN_INSIDE
    near, far = inside & step.isin("M1", "M2"), inside & (step == "M3")
    whole, tail = service == V.FULL_SERVICE, service == V.MID_AND_LAST_MILE
    return [
        Tariff("outside", F.col("origin_status") == V.ORIGIN_OUTSIDE, F.col("price_e2e_tts")),
        Tariff("near full", near & whole, e2e),
        Tariff("far full listed", far & whole & (F.col("is_kr_whitelist") == 1), e2e),
        Tariff("far full", far & whole, first + last, e2e - first - last),
        Tariff("first mile", (near | far) & (service == V.FIRST_MILE_ONLY), first),
        Tariff("near tail", near & tail, middle + last),
        Tariff("far tail", far & tail, last, middle),
    ]


class NetRule(NamedTuple):
    """One net-fee arm by column names: ``base - part * share``, or ``base`` as it is."""

    name: str
    applies: Column
    base: str
    part: str | None = None
    share: str | None = None


def net_fee_rules(faithful: bool = True) -> list[NetRule]:
    """Net fee arms in order of precedence.

    The standard discount is switched off in the finance rules as they stand (the rate is
    read as zero); ``faithful=False`` applies it.
    """
    total, standard, received = "total_fee", "standard_fee", "receivable_fee"
    gross, share = "card_gross", "tariff_share"
    special = F.col("key_account_name") == V.SPECIAL_ACCOUNT
    # Read as zero, the rate still leaves no fee where the standard fee is missing.
    contract_share = "no_share" if faithful else "standard_share"
    contract = NetRule("standard rate", F.col("standard_client").isNotNull(), total, standard, contract_share)
    has_api_rate = F.col("api_source").isNotNull() & F.col("express_type_name").isin(*V.API_RATE_COLUMN)
    return [
        NetRule("platform card", _source(V.SOURCE_PLATFORM), total, standard, share),
        NetRule("crossborder card", _source(V.SOURCE_CROSSBORDER), gross, gross, share),
        NetRule("express card", _source(V.SOURCE_EXPRESS), gross, gross, share),
        NetRule("marketplace", F.col("marketplace_arm").isNotNull(), "marketplace_fee"),
        NetRule("special account rate", special & F.col("special_listed"), received, received, "special_share"),
        NetRule("special account", special, total),
        NetRule("area rate", _source(*V.SOURCES_AREA_RATE), total, standard, share),
        NetRule("destination rate", _source(*V.SOURCES_DESTINATION_RATE), total, total, share),
        NetRule("net-off report", F.col("netoff_waybill").isNotNull(), "netoff_fee"),
        NetRule("wallet", F.col("wallet_waybill").isNotNull(), "wallet_net"),
        contract,
        NetRule("api", has_api_rate, total, standard, "api_share"),
    ]


def net_arm() -> Column:
    """Name of the arm that settles the net fee; NULL where the total fee stands."""
    return first_match([Rule(r.name, r.applies, F.lit(r.name)) for r in net_fee_rules()])


def net_parts(faithful: bool = True) -> dict[str, Column]:
    """The numbers that the arm in ``net_arm`` settles the net fee by."""
    rules = net_fee_rules(faithful)
    arm, none = F.col("net_arm"), F.lit(0)

    def chosen(field: str, scale: str, otherwise: Column) -> Column:
        """The column that the deciding arm names for ``field``."""
        users: dict[str, list[str]] = {}
        for rule in rules:
            if column := getattr(rule, field):
                users.setdefault(column, []).append(rule.name)
        arms = [Rule(column, arm.isin(*names), F.col(column).cast(scale)) for column, names in users.items()]
        return first_match(arms, otherwise.cast(scale))

    return {
        "net_base": chosen("base", FEE, F.col("total_fee")),
        "net_part": chosen("part", FEE, none),
        "net_share": chosen("share", RATE, none),
    }


def _reduced(base: Column, part: Column, share: Column) -> Column:
    reduced = fee(base - fee(part * share))
    taxed = fee(reduced + fee(reduced * F.lit(V.EXPRESS_TAX)))
    return F.when(F.col("net_arm") == "express card", taxed).otherwise(reduced)


def net_fee(faithful: bool = True) -> Column:
    """Net fee by the arm in ``net_arm``; the express card adds its tax."""
    return _reduced(*net_parts(faithful).values())


def cod_fee_rules() -> list[Rule]:
    """Fee on cash collected; only delivered waybills carry one."""
    cash = F.col("cod_value")

    def taxed(share: Column) -> Column:
        base = fee(cash * share)
        return fee(base + fee(base * F.lit(V.VAT_RATE)))

    collected = cash > 0
    fixed = F.lit(V.COD_RATE)
    return [
        Rule("not delivered", F.col("pod_record_time").isNull(), fee(F.lit(0))),
        Rule("platform and express", _source(V.SOURCE_PLATFORM, V.SOURCE_EXPRESS) & collected, taxed(fixed)),
        Rule(
            "crossborder city",
            _source(V.SOURCE_CROSSBORDER) & collected & (F.col("sender_city_name") == V.CROSSBORDER_COD_CITY),
            fee(cash * fixed),
        ),
        Rule(
            "net-off report",
            F.col("netoff_waybill").isNotNull() & collected,
            fee(F.col("netoff_cod_fee") + F.col("netoff_cod_vat")),
        ),
        Rule(
            "api",
            F.col("api_source").isNotNull()
            & ~F.col("waybill_source_name").isin(*V.SOURCES_WITHOUT_API_COD)
            & collected,
            taxed(F.col("api_cod_rate")),
        ),
    ]


def cod_fee() -> Column:
    return first_match(cod_fee_rules(), fee(F.lit(0)))


def return_fee_rules() -> list[Rule]:
    return [
        Rule("net-off report", F.col("netoff_waybill").isNotNull(), fee(F.col("netoff_return_fee"))),
        Rule("api", F.col("api_source").isNotNull(), fee(F.col("return_fee") * F.col("api_return_rate"))),
    ]


def return_fee() -> Column:
    return first_match(return_fee_rules(), fee(F.lit(0)))


def chargeable_weight(value: ColumnLike) -> Column:
    """Billed kilograms: up to 1.309 kg count as one, beyond that 0.31 kg are free."""
    # One digit less than a weight can have, so that the difference keeps all nine decimals.
    kilos = as_column(value).try_cast("decimal(37,9)")
    rounded = F.ceil(kilos - F.lit(V.WEIGHT_ROUNDING)).cast("decimal(30,0)")
    return F.when(kilos <= F.lit(V.FREE_WEIGHT_UP_TO), F.lit(1).cast("decimal(30,0)")).otherwise(rounded)


def pod_date(tz: str = JAKARTA) -> Column:
    """Day of delivery, else day of the delivered return, as a datetime at midnight."""
    return day_start(local_date(F.coalesce("pod_record_time", "return_pod_record_time"), tz))


def pod_category() -> Column:
    return F.when(F.col("pod_record_time").isNull(), V.POD_RETURN).otherwise(V.POD_DELIVERY)


def _day_and_weights(tz: str) -> dict[str, Column]:
    """What the waybill alone decides."""
    return {
        "pod_date": pod_date(tz),
        "pod_category": pod_category(),
        "cod_flag": F.when(F.col("cod_value") == 0, "Non COD").otherwise("COD"),
        "cargo_weight": F.when(F.col("express_type_name") == V.CARGO_EXPRESS, F.col("calculated_weight")),
        "chargeable_weight": chargeable_weight("calculated_weight"),
    }


# --- pipeline ---------------------------------------------------------------------------

def _day_waybills(waybills: DataFrame, as_of: date, days: int, tz: str) -> DataFrame:
    first, last = as_of - timedelta(days=days), as_of - timedelta(days=1)
    in_day = within_days("pod_record_time", first, last, tz) | within_days(
        "return_pod_record_time", first, last, tz
    )
    rows = waybills.filter(
        in_day
        & ~F.col("pickup_branch_name").isin(*V.EXCLUDED_BRANCHES)
        & (F.col("void_flag") == "0")
        & (F.col("deleted") == "0")
    )
    return rows.select(
        "waybill_no", "return_waybill_no", "pod_record_time", "return_pod_record_time", "shipping_time",
        "waybill_source", "express_type", "key_account_name", "parent_client_identifier", "sender_name",
        "sender_city_name", "sender_city_id", "recipient_city_name", "recipient_district_name",
        "recipient_district_id", "vip_customer_id",
        amount("cod_amount").alias("cod_value"),
        amount("total_shipping_fee").alias("total_fee"),
        amount("standard_shipping_fee").alias("standard_fee"),
        amount("receivable_shipping_fee").alias("receivable_fee"),
        weight("item_actual_weight").alias("actual_weight_value"),
        weight("item_calculated_weight").alias("calculated_weight"),
    )


# Facts that share the waybill number: one shuffle of the day's rows serves them all.

def _fact(df: DataFrame, fact: DataFrame, keys: dict, take: dict, gate: Column | None = None) -> DataFrame:
    """Merged however small it is, so that the rules before and after it are in methods of their own."""
    return lookup(df, fact.hint("merge"), keys, take, gate=gate)


def _with_orders(df: DataFrame, tables: Tables, as_of: date, days: int, tz: str) -> DataFrame:
    orders = recent(tables["fact_orders"], "input_time", days, as_of, tz).filter(
        ~F.col("order_no").isin(*V.EXCLUDED_ORDERS)
    )
    return _fact(
        df, orders, {"waybill_no": "waybill_no"},
        {"order_origin": "sender_city_name", "order_destination": "recipient_city_name", "order_source": "order_source"},
    )


def _with_partner_orders(df: DataFrame, tables: Tables, as_of: date, days: int, tz: str) -> DataFrame:
    partner_orders = recent(tables["fact_partner_orders"], "create_time", days, as_of, tz)
    return _fact(
        df, partner_orders, {"waybill_number": "waybill_no"},
        {"role_miles": "role_miles", "is_kr_whitelist": "is_kr_whitelist"},
        gate=_source(V.SOURCE_MARKETPLACE),
    )


def _with_netoff(df: DataFrame, tables: Tables, as_of: date, days: int) -> DataFrame:
    # The creation stamp of the net-off report is compared without a zone shift.
    netoff = recent(tables["agg_daily_netoff_report"], "created_at", days, as_of, "UTC")
    return _fact(
        df, netoff, {"waybill_no": "waybill_no"},
        {
            "netoff_waybill": "waybill_no",
            "netoff_fee": amount("after_discount_shipping_fee"),
            "netoff_return_fee": amount("after_discount_return_shipping_fee"),
            "netoff_cod_fee": amount("cod_fee"),
            "netoff_cod_vat": amount("vat_cod_fee"),
        },
    )


def _with_returns(df: DataFrame, tables: Tables, as_of: date, days: int, tz: str) -> DataFrame:
    return _fact(
        df, non_ecommerce_returns(tables, as_of, tz, days),
        {"waybill_no": "waybill_no", "return_waybill_no": "return_waybill_no"},
        {"return_fee": "return_shipping_fee"},
    )


def _with_wallet(df: DataFrame, tables: Tables, as_of: date, days: int, tz: str) -> DataFrame:
    return _fact(
        df, _wallet(tables, as_of, days, tz), {"waybill_no": "waybill_no"},
        {"wallet_waybill": "waybill_no", "wallet_total": "total_shipping_fee", "wallet_net": "net_shipping_fee"},
    )


def _wallet(tables: Tables, as_of: date, days: int, tz: str) -> DataFrame:
    """Wallet fees per waybill: from maintained sums where the tables have them, else from the whole history.

    Of the sums only rows of the day's waybills are spread and added up.
    """
    if "wallet_totals" not in tables:
        return wallet_per_waybill(tables["agg_wallet_summary"])
    due = _day_waybills(tables["fact_waybill_details"], as_of, days, tz).select("waybill_no")
    return wallet_per_waybill(tables["wallet_totals"].join(due, "waybill_no", "left_semi"))


def _with_codes(df: DataFrame, tables: Tables) -> DataFrame:
    codes = tables["dim_system_codes"]
    df = decode(df, codes, "waybill_source", V.WAYBILL_SOURCE, "waybill_source_name")
    df = decode(df, codes, "express_type", V.EXPRESS_TYPE, "express_type_name")
    api_key = F.col("waybill_source")
    for code, alias in V.SOURCE_API_ALIAS.items():
        api_key = F.when(F.col("waybill_source") == code, alias).otherwise(api_key)
    api = tables["dim_api_platform_discounts"].filter(F.col("shipping_client").isNotNull())
    df = lookup(
        df, api, {"option_value": api_key},
        {
            "api_source": "order_source",
            "company_name": "partner_company_name",
            "api_cod_rate": rate("cod_fee_percentage"),
            "api_return_rate": rate("return_fee_percentage"),
            **{f"api_{c}": rate(c) for c in V.API_RATE_COLUMN.values()},
        },
        gate=F.col("waybill_source") != V.SOURCE_WITHOUT_API_RATE,
    )
    by_type = [
        Rule(name, F.col("express_type_name") == name, F.col(f"api_{column}"))
        for name, column in V.API_RATE_COLUMN.items()
    ]
    return _fold(df, {"api_share": first_match(by_type)}, [f"api_{c}" for c in V.API_RATE_COLUMN.values()])


def _fold(df: DataFrame, results: dict[str, Column], parts: list[str]) -> DataFrame:
    """Replace looked-up columns by what the rules need of them.

    A waybill passes a dozen lookups; carrying results instead of parts keeps rows
    narrow and the generated code small enough to be compiled.
    """
    return df.withColumns(results).drop(*parts)


ANY = "*"
PART = "\u001f"


def _tariff_key() -> dict[str, Column]:
    """Key of a waybill into the tariff cards: which card, and the parts it is priced by."""
    platform, crossborder = _source(V.SOURCE_PLATFORM), _source(V.SOURCE_CROSSBORDER)
    express = _source(V.SOURCE_EXPRESS)
    joined = platform | crossborder
    card = first_match(
        [
            Rule("platform", platform, F.lit("platform")),
            Rule("crossborder", crossborder, F.lit("crossborder")),
            Rule("express", express, F.lit("express")),
            Rule("marketplace", _source(V.SOURCE_MARKETPLACE), F.lit("marketplace")),
            Rule(
                "destination",
                _source(*V.SOURCES_DESTINATION_RATE),
                F.concat(F.lit("destination "), "waybill_source_name"),
            ),
        ]
    )
    city, district = F.col("recipient_city_name"), F.col("recipient_district_name")
    return {
        "card": card,
        "origin": F.col("sender_city_name"),
        "destination": F.when(joined, F.concat(city, district)).otherwise(F.concat(city, F.lit(PART), district)),
        "express": F.when(express, F.col("express_type_name")).otherwise(ANY),
    }


def tariff_cards(tables: Tables) -> DataFrame:
    """The tariff cards in one table: a waybill is priced by one card, so one lookup serves.

    A union keeps the known size of its parts, so Spark still sees a small table.
    ``light_share`` is the discount of parcels below half a kilogram, which only the
    platform card tells apart.
    """
    nothing = F.lit(None)

    def card(
        rows: DataFrame, name: Column, origin: Column, destination: Column, express: Column,
        price: Column, share: Column, light_share: Column | None = None,
    ) -> DataFrame:
        return rows.select(
            name.alias("card"), origin.alias("origin"), destination.alias("destination"), express.alias("express"),
            price.cast("decimal(18,4)").alias("price"), share.alias("share"),
            (share if light_share is None else light_share).alias("light_share"),
        )

    def place(city: str, district: str) -> Column:
        return F.concat(city, F.lit(PART), district)

    platform = tables["dim_platform_discounts"]
    standard = rate("STD")
    parts = [
        card(
            platform, F.lit("platform"), F.col("Origin"), F.col("Lookup"), F.lit(ANY), nothing, standard,
            F.when(F.col("IDlite_availability") == "Available", rate("IDlite")).otherwise(standard),
        ),
        card(
            tables["dim_crossborder_discounts"], F.lit("crossborder"), F.col("origin"), F.col("lookup_destination"),
            F.lit(ANY), amount("pricing"), rate("discount_rate"),
        ),
        card(
            tables["dim_express_discounts"], F.lit("express"), F.col("origin"), place("kota_kabupaten", "kecamatan"),
            F.col("express_type"), amount("pricing"), rate("discount"),
        ),
        card(
            tables["dim_destination_discounts"], F.concat(F.lit("destination "), "waybill_source"), F.col("origin_city"),
            place("dest_city", "dest_district"), F.lit(ANY), nothing,
            ratio(amount("gross") - amount("nett"), amount("gross")),
        ),
    ]
    return reduce(DataFrame.unionByName, parts)


def weight_tiers(tables: Tables) -> DataFrame:
    """Weight tiers of the three tariffs that have them, in one table."""
    names = {
        "express": "dim_express_weight_tiers",
        "crossborder": "dim_crossborder_weight_tiers",
        "marketplace": "dim_marketplace_weight_tiers",
    }
    parts = [
        tables[table].select(F.lit(card).alias("card"), *[amount(c).alias(c) for c in ("Bottom", "Up", "Multiplier")])
        for card, table in names.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _with_cards(df: DataFrame, tables: Tables) -> DataFrame:
    """Weight multiplier and the row of the waybill's tariff card."""
    key = _tariff_key()
    df = tier_lookup(
        df, weight_tiers(tables), "actual_weight_value", {"tier": "Multiplier"}, keys={"card": key["card"]}
    )
    return lookup(
        df, tariff_cards(tables), key,
        {"card_price": "price", "card_share": "share", "card_light_share": "light_share"},
    )


def _with_tariff(df: DataFrame, tables: Tables) -> DataFrame:
    """Gross fee and discount share of the waybill's tariff card, after ``_with_cards``."""
    by_area = _source(*V.SOURCES_AREA_RATE)
    df = lookup(
        df, tables["dim_area_coverage"],
        {"dest_city": "recipient_city_name", "dest_district": "recipient_district_name"},
        {"master_agent": "master_agent"},
        gate=by_area,
    )
    df = lookup(
        df, tables["dim_area_discounts"], {"area": "master_agent", "express_type": "express_type_name"},
        {"area_share": rate("discount")},
        gate=by_area,
    )
    light = F.col("actual_weight_value") < F.lit(V.LITE_WEIGHT_BELOW)
    card_share = F.when(light, F.col("card_light_share")).otherwise(F.col("card_share"))
    return _fold(
        df,
        {
            "card_gross": fee(F.col("card_price") * F.col("tier")),
            "tariff_share": F.when(by_area, F.col("area_share")).otherwise(card_share),
        },
        ["card_price", "card_share", "card_light_share", "master_agent", "area_share"],
    )


def _with_marketplace(df: DataFrame, tables: Tables, scheme_start: date, tz: str) -> DataFrame:
    legs = ("e2e", "e2e_tts", "fm", "mm", "lm")
    df = lookup(
        df, tables["dim_marketplace_pricing"],
        {"Origin_City": "order_origin", "Dest_City": "order_destination"},
        {"origin_status": "status", "city_type": "type_m", **{f"price_{leg}": amount(leg) for leg in legs}},
        gate=F.col("order_source") == V.SOURCE_MARKETPLACE,
    )
    tariffs = marketplace_tariffs()
    scheme = _source(V.SOURCE_MARKETPLACE) & since("shipping_time", scheme_start, tz)
    df = df.withColumn(
        "marketplace_arm",
        F.when(scheme, first_match([Rule(t.name, t.applies, F.lit(t.name)) for t in tariffs])),
    )
    arm = F.col("marketplace_arm")
    nothing = F.lit(0).cast(AMOUNT)
    per_tier = first_match([Rule(t.name, arm == t.name, t.per_tier.cast(AMOUNT)) for t in tariffs])
    per_kilo = first_match([Rule(t.name, arm == t.name, t.per_kilo.cast(AMOUNT)) for t in tariffs if t.per_kilo is not None], nothing)
    kilos = F.when(per_kilo == 0, F.lit(0).cast(RATE)).otherwise(factor("actual_weight_value"))
    # Both parts leave room for the other's scale, so their sum is exact before the one rounding.
    by_weight = (kilos * per_kilo).try_cast("decimal(31,13)")
    by_tier = (F.col("tier") * per_tier).try_cast("decimal(26,8)")
    return _fold(
        df,
        {"marketplace_fee": fee(by_tier + by_weight)},
        [
            "order_origin", "order_destination", "order_source", "origin_status", "city_type", "tier",
            "role_miles", "is_kr_whitelist", *[f"price_{leg}" for leg in legs],
        ],
    )


def _with_account_rates(df: DataFrame, tables: Tables, as_of: date, tz: str) -> DataFrame:
    """Discounts of the special account and of standard contracts."""
    df = lookup(
        df, tables["dim_special_account_discounts"],
        {
            "origin_city": "sender_city_name",
            "dest_city": "recipient_city_name",
            "dest_district": "recipient_district_name",
        },
        {
            "special_listed": F.col("_gross_").isNotNull(),
            "special_share": ratio(amount("_gross_") - amount("_nett_"), amount("_gross_")),
        },
        gate=F.col("key_account_name") == V.SPECIAL_ACCOUNT,
    )
    return lookup(
        df, active_standard_rates(tables["dim_standard_rates"], as_of, tz, distinct=True),
        {
            "shipping_client_id": "vip_customer_id",
            "sender_location_id": "sender_city_id",
            "recipient_location_id": "recipient_district_id",
            "express_type": "express_type",
        },
        {
            "standard_client": "shipping_client_id",
            "no_share": F.lit(0).cast(RATE),
            "standard_share": (F.coalesce(rate("discount_rate"), F.lit(0).cast(RATE)) / F.lit(100)).cast(RATE),
        },
    )


def priced_waybills(
    tables: Tables,
    as_of: date,
    tz: str = JAKARTA,
    days: int = 1,
    scheme_start: date = V.MARKETPLACE_SCHEME_START,
    faithful: bool = True,
) -> DataFrame:
    """The day's waybills with every lookup the fee rules read, and what is settled on the way.

    Small lookups and rules stand between the joins of facts: Spark makes one method of all that follows a join of
    facts, and the JVM compiles none above 8,000 bytes.
    """
    rows = _with_codes(_day_waybills(tables["fact_waybill_details"], as_of, days, tz), tables)
    rows = _with_orders(rows, tables, as_of, days, tz).withColumns(_day_and_weights(tz))
    rows = _with_netoff(_with_cards(rows, tables), tables, as_of, days).withColumn("cod_fee", cod_fee())
    rows = _with_account_rates(_with_tariff(rows, tables), tables, as_of, tz)
    rows = _with_partner_orders(rows, tables, as_of, days, tz)
    rows = _with_marketplace(rows, tables, scheme_start, tz)
    rows = _with_wallet(rows, tables, as_of, days, tz).withColumns({"gross_fee": gross_fee(), "net_arm": net_arm()})
    return _with_returns(rows.withColumns(net_parts(faithful)), tables, as_of, days, tz)


def daily_billing(
    tables: Tables,
    as_of: date,
    tz: str = JAKARTA,
    days: int = 1,
    faithful: bool = True,
    scheme_start: date = V.MARKETPLACE_SCHEME_START,
) -> DataFrame:
    """Billing rows of the ``days`` local days before the reporting date.

    One row per distinct priced waybill. A net or return fee that no rule could settle is
    taken from the waybill fee table. With a table ``wallet_totals`` (``wallet_totals.totals``)
    the wallet history is not read.
    """
    priced = priced_waybills(tables, as_of, tz, days, scheme_start, faithful)
    charged = priced.select(
        "waybill_no",
        "pod_date",
        "waybill_source_name",
        "company_name",
        "key_account_name",
        F.col("parent_client_identifier").alias("parent_shipping_client"),
        "pod_category",
        "cod_flag",
        "express_type_name",
        "cargo_weight",
        F.col("total_fee").alias("original_total_shipping_fee"),
        F.col("gross_fee").alias("total_shipping_fee"),
        _reduced(F.col("net_base"), F.col("net_part"), F.col("net_share")).alias("net_shipping_fee"),
        "cod_fee",
        return_fee().alias("return_shipping_fee"),
        F.col("cod_value").alias("cod_amount"),
        F.col("calculated_weight").alias("actual_weight"),
        "chargeable_weight",
        "sender_name",
    ).distinct()

    stored = recent(tables["fact_waybill_fees"], "create_time", days, as_of, tz)
    settled = lookup(
        charged, stored, {"waybill_no": "waybill_no"},
        {"__net": amount("net_shipping_fee"), "__return": amount("return_shipping_fee")},
    )
    return settled.withColumns(
        {
            "net_shipping_fee": F.coalesce("net_shipping_fee", fee(F.col("__net"))),
            "return_shipping_fee": F.coalesce("return_shipping_fee", fee(F.col("__return"))),
        }
    ).select(*BILLING_COLUMNS)


MONEY_COLUMNS = (
    "cargo_weight",
    "original_total_shipping_fee",
    "total_shipping_fee",
    "net_shipping_fee",
    "cod_fee",
    "return_shipping_fee",
    "cod_amount",
    "actual_weight",
    "chargeable_weight",
)


def billing_report(billing: DataFrame) -> DataFrame:
    """Billing rows with amounts as floating point, for exports."""
    return billing.withColumns({c: as_float(c) for c in MONEY_COLUMNS})
