"""The price report: services by coverage, providers by their totals, settings by price; as tables and as nested rows."""

from __future__ import annotations

import html

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tariffloom.functions import columns as C


def _text(df: DataFrame, name: str) -> Column:
    return F.col(name).cast("string") if name in df.columns else F.lit(None).cast("string")


def base(fact: DataFrame) -> DataFrame:
    """Rows with a price and a provider: provider, service_key, code, service, rate, setting columns, npis, address."""
    t = lambda n: _text(fact, n)
    code = C.first_filled(t("billing_code"))
    full = C.first_filled(t("description"), t("name"), F.lit("Unknown service"))
    place = ("practice_addr_line1", "practice_addr_line2", "practice_city", "practice_state", "practice_postal_code")
    address = C.first_filled(t("practice_location"), C.joined(", ", *(t(n) for n in place)), F.lit("Address not listed"))
    other = lambda n: C.first_filled(t(n), F.lit("unknown"))
    rows = fact.select(
        C.first_filled(t("provider_name"), t("provider_org_name"), t("name"), t("source_file_provider")).alias("provider"),
        F.concat_ws("|", code, full).alias("service_key"), code.alias("code"), C.shortened(full).alias("service"), C.rate(t("negotiated_rate")).alias("rate"),
        other("negotiation_arrangement").alias("arrangement"), other("billing_class").alias("billing_class"), other("negotiated_type").alias("negotiated_type"),
        C.digit_runs(t("npi")).alias("npis"), address.alias("address"),
    )
    return rows.where("rate is not null and provider <> ''")


def provider_services(rows: DataFrame) -> DataFrame:
    """Lowest and highest price of each provider and service."""
    return rows.groupBy("provider", "service_key", "code", "service").agg(F.min("rate").alias("low"), F.max("rate").alias("high"))


def coverage(pairs: DataFrame) -> DataFrame:
    """How many providers offer each service."""
    return pairs.groupBy("service_key", "code", "service").agg(F.countDistinct("provider").alias("coverage"))


def top_services(covered: DataFrame, k: int) -> DataFrame:
    """The k services most providers offer, ties by code and name, with rank from 1."""
    top = covered.orderBy(F.desc("coverage"), "code", "service", "service_key").limit(k)
    return top.withColumn("rank", F.row_number().over(W.orderBy(F.desc("coverage"), "code", "service", "service_key")))


def provider_totals(pairs: DataFrame, services: DataFrame) -> DataFrame:
    """For each provider how many of the services it offers and the sums of their lowest and highest prices, and the middle.

    services is a top-k table, so it is small.
    """
    own = pairs.join(services.select("service_key"), "service_key")
    total = own.groupBy("provider").agg(F.count("*").alias("present"), F.sum("low").alias("low_sum"), F.sum("high").alias("high_sum"))
    return total.withColumn("mid_sum", (F.col("low_sum") + F.col("high_sum")) / 2)


def top_providers(totals: DataFrame, k: int) -> DataFrame:
    """The k providers with the most services, then the lowest middle, ranked by middle and name."""
    top = totals.orderBy(F.desc("present"), "mid_sum", "provider").limit(k)
    return top.withColumn("rank", F.row_number().over(W.orderBy("mid_sum", "provider")))


def settings(rows: DataFrame, k: int = 8) -> DataFrame:
    """The k cheapest settings of each provider and service: setting letter, rounded prices (half to even), identifiers (1 if
    none is named), and how many settings there are."""
    keys = ["provider", "service_key", "arrangement", "billing_class", "negotiated_type"]
    own = rows.withColumn("npi", F.explode_outer("npis")).groupBy(*keys).agg(F.min("rate").alias("low"), F.max("rate").alias("high"), F.countDistinct("npi").alias("npi"))
    by = W.partitionBy("provider", "service_key")
    ranked = own.withColumn("place", F.row_number().over(by.orderBy("low", *keys[2:]))).withColumn("n_settings", F.count("*").over(by)).where(F.col("place") <= k)
    return ranked.select(*keys, F.concat(F.lit("Setting "), F.chr(F.col("place") + 64)).alias("setting"), F.bround("low", 0).cast("long").alias("low"), F.bround("high", 0).cast("long").alias("high"), F.greatest("npi", F.lit(1)).alias("npi"), "n_settings", "place")


def against_average(totals: DataFrame, band: float = 0.08) -> DataFrame:
    """Each provider's middle against the average of all: delta and whether it is below, near or above."""
    delta = F.col("mid_sum") / F.col("average") - 1
    known = totals.sparkSession.sql("SELECT *, (SELECT avg(mid_sum) FROM {t}) AS average FROM {t}", t=totals)
    return known.withColumn("delta", delta).withColumn("standing", F.when(delta < -band, "below").when(delta > band, "above").otherwise("near"))


def metrics(pairs: DataFrame, services: DataFrame, settings_of: DataFrame) -> DataFrame:
    """For each provider the lowest and highest totals of the selected services, the share of them it offers in percent, and
    the median of the middles of its settings. services: the selected ones; settings_of: see `settings`."""
    total = provider_totals(pairs, services)
    known = total.sparkSession.sql("SELECT *, (SELECT count(*) FROM {s}) AS n_services FROM {t}", t=total, s=services)
    middles = settings_of.join(services.select("service_key"), "service_key", "left_semi").groupBy("provider").agg(F.median((F.col("low") + F.col("high")) / 2).alias("median_mid"))
    return known.select("provider", "low_sum", "high_sum", (F.lit(100.0) * F.col("present") / F.col("n_services")).alias("coverage_pct")).join(middles, "provider", "left")


def price_stats(prices: DataFrame, keys: list[str], rate: str = "negotiated_rate") -> DataFrame:
    """How many different prices there are for the keys, and their average."""
    return prices.groupBy(*keys).agg(F.countDistinct(rate).alias("count_rates"), F.avg(rate).alias("avg_rates"))


def page(services: DataFrame, providers: DataFrame, title: str = "Prices") -> str:
    """The report (see `report`) as one HTML page without scripts. Both tables are top-k tables, so they are small."""
    text = lambda v: html.escape(str(v), quote=True)
    chosen = services.orderBy(F.desc("coverage"), "code", "name").collect()
    out = [f"<!doctype html><html><head><meta charset='utf-8'><title>{text(title)}</title></head><body><h1>{text(title)}</h1>"]
    out.append("<h2>Services</h2><table><tr><th>Code</th><th>Service</th><th>Providers</th></tr>")
    out += [f"<tr id='{text(r['id'])}'><td>{text(r['code'])}</td><td>{text(r['name'])}</td><td>{r['coverage']}</td></tr>" for r in chosen]
    out.append("</table>")
    for p in providers.orderBy("rank").collect():
        out.append(f"<section id='{text(p['id'])}'><h2>{text(p['name'])}</h2><p>{text(p['address'])}</p><p>{p['present']} services, {p['low_sum']:,.0f} to {p['high_sum']:,.0f}</p><ul>")
        for s in p["services"]:
            rows = "".join(f"<li>{text(x['setting'])}: {text(x['arrangement'])}, {text(x['billing_class'])}, {text(x['negotiated_type'])}: {x['low']:,} to {x['high']:,} ({x['npi']})</li>" for x in s["settings"])
            out.append(f"<li><a href='#{text(s['service_id'])}'>{text(s['service_id'])}</a> {s['low']:,} to {s['high']:,} {text(s['note'])}<ul>{rows}</ul></li>")
        out.append("</ul></section>")
    return "".join([*out, "</body></html>"])


def report(fact: DataFrame, services: int = 10, providers: int = 20) -> tuple[DataFrame, DataFrame]:
    """(services, providers) of a report: the providers with their services and settings nested, as a page needs them."""
    rows = base(fact)
    pairs = provider_services(rows)
    chosen = top_services(coverage(pairs), services).withColumn("service_id", F.concat(F.lit("s"), F.col("rank")))
    top = top_providers(provider_totals(pairs, chosen), providers)
    keys = ["provider", "service_key"]
    wanted = rows.join(top.select("provider"), "provider", "left_semi").join(chosen.select("service_key"), "service_key", "left_semi")
    each = settings(wanted).groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("place", "setting", "arrangement", "billing_class", "negotiated_type", "low", "high", "npi"))).alias("settings"), F.max("n_settings").alias("n_settings"))
    own = pairs.join(each, keys).join(chosen.select("service_key", "service_id", F.col("rank").alias("service_rank")), "service_key")
    nested = own.groupBy("provider").agg(F.array_sort(F.collect_list(F.struct("service_rank", "service_id", F.bround("low", 0).cast("long").alias("low"), F.bround("high", 0).cast("long").alias("high"), F.format_string("(%d settings)", "n_settings").alias("note"), "settings"))).alias("services"))
    address = wanted.groupBy("provider").agg(F.min("address").alias("address"))
    page = top.join(nested, "provider").join(address, "provider").select(F.concat(F.lit("h"), F.col("rank")).alias("id"), "rank", F.col("provider").alias("name"), "address", "present", "low_sum", "high_sum", "mid_sum", "services")
    return chosen.select(F.col("service_id").alias("id"), F.col("service").alias("name"), "code", "coverage"), page
