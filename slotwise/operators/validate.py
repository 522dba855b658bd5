"""Ordered row rules: the first that fails is the reason."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slotwise.functions import scalars as S


def reason(rules: Sequence[tuple[Column, str]]) -> Column:
    """The message of the first rule that doesn't hold (NULL counts as not holding), NULL if all do."""
    return F.coalesce(*[F.when(~F.coalesce(ok, F.lit(False)), message) for ok, message in rules], F.lit(None).cast("string"))


def split(df: DataFrame, why: Column) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with their reason)."""
    tagged = df.withColumn("reason", why)
    return tagged.where("reason IS NULL").drop("reason"), tagged.where("reason IS NOT NULL")


def safe_url(url: Column, http: bool = False) -> Column:
    """https, a host, nobody's name in it, not localhost and not a private address."""
    scheme, host, user = (F.try_parse_url(url, F.lit(p)) for p in ("PROTOCOL", "HOST", "USERINFO"))
    ok = scheme.isin(*(["https", "http"] if http else ["https"])) & host.isNotNull() & (host != "") & user.isNull()
    private = host.rlike(r"^(10|127|0)\.|^192\.168\.|^169\.254\.|^172\.(1[6-9]|2[0-9]|3[01])\.|^100\.(6[4-9]|[7-9][0-9]|1[01][0-9]|12[0-7])\.|^\[(::1?|f[cd]|fe80)") | (F.lower(host) == "localhost")
    return F.coalesce(ok if http else ok & ~private, F.lit(False))


def host_allowed(url: Column, hosts: Sequence[str]) -> Column:
    """Whether an address is at one of the hosts or below one."""
    host = F.lower(F.try_parse_url(url, F.lit("HOST")))
    return F.coalesce(F.exists(F.array(*map(F.lit, hosts)), lambda h: (host == h) | host.endswith(F.concat(F.lit("."), h))), F.lit(False))


def report_rules(countries: Sequence[str] = ("USA", "GBR")) -> list[tuple[Column, str]]:
    """The manifest's rules in their order."""

    def c(name: str) -> Column:
        return F.trim(F.coalesce(F.col(name), F.lit("")))

    return [
        (c("country").isin(*countries), f"country must be {' or '.join(countries)}"),
        (c("exchange").rlike(S.MIC), "exchange must be a four-character MIC"),
        (c("lei").rlike(S.LEI), "LEI must contain 20 uppercase letters/digits"),
        (c("isin").rlike(S.ISIN), "ISIN must contain 12 uppercase letters/digits"),
        (c("ticker").rlike(S.TICKER), "ticker must be 1-16 uppercase letters, digits, dots or hyphens"),
        (c("fiscal_year").rlike(S.FISCAL_YEAR), "fiscal_year must look like FY2024"),
        (c("report_type").isin(*S.REPORT_TYPES), "unknown SOP report_type"),
        (c("language") == "EN", "only complete English PDFs (EN) are in scope"),
        (safe_url(c("pdf_url")), "pdf_url must be an absolute HTTPS URL"),
        ((c("source_page") == "") | safe_url(c("source_page")), "source_page must be an absolute HTTPS URL"),
        (F.lower(c("verified")).isin("true", "false"), "verified must be true or false"),
    ]
