"""Country, language and currency codes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Codes seen in the data and what they stand for; None is no country.
COUNTRY_REMAP = {
    "EL": "GR",
    "UK": "GB",
    "ZR": "CD",
    "YU": "RS",
    "CS": "RS",
    "AN": "CW",
    "QAT": "QA",
    "LIE": "LI",
    "ZZ": None,
    "EU": None,
    "DC": None,
    "DD": None,
    "OC": None,
    "EUROPE": None,
    "WORLD": None,
}
EXTRA_COUNTRIES = ("XK",)

# Bibliographic language codes and their terminological ones.
LANGUAGE_REMAP = {
    "alb": "sqi", "arm": "hye", "baq": "eus", "bur": "mya", "chi": "zho", "cze": "ces", "dut": "nld", "fre": "fra", "geo": "kat",
    "ger": "deu", "gre": "ell", "ice": "isl", "mac": "mkd", "mao": "mri", "may": "msa", "per": "fas", "rum": "ron", "slo": "slk",
    "tib": "bod", "wel": "cym", "esl": "spa",
}

# Units of a currency per euro.
UNITS_PER_EUR = {
    "EUR": 1.0, "USD": 1.1460, "JPY": 180.94, "CZK": 24.339, "DKK": 7.4754, "GBP": 0.85880, "HUF": 364.28, "PLN": 4.3635,
    "RON": 5.2647, "SEK": 11.2915, "CHF": 0.9462, "ISK": 139.40, "NOK": 10.8095, "TRY": 55.9077, "AUD": 1.6095, "BRL": 5.8857,
    "CAD": 1.6056, "CNY": 7.6755, "HKD": 8.9903, "IDR": 20424.81, "ILS": 3.4812, "INR": 109.8755, "KRW": 1590.76, "MXN": 19.6855,
    "MYR": 4.6763, "NZD": 2.0068, "PHP": 71.972, "SGD": 1.4651, "THB": 38.225, "ZAR": 18.6482, "HRK": 7.53450, "BGN": 1.95583,
}
MAX_EUR = 1e9


def iso_countries(spark: SparkSession) -> list[str]:
    """Two-letter codes of the Java runtime's ISO 3166 table, and the extra ones."""
    return sorted({*spark.sparkContext._jvm.java.util.Locale.getISOCountries(), *EXTRA_COUNTRIES} - {"AN"})


def norm_country(c: Column, valid: list[str]) -> Column:
    """A valid upper-case code, remapped where it is a known other one, else null."""
    code = F.upper(F.btrim(c))
    remap = F.create_map(*[F.lit(x) for k, v in COUNTRY_REMAP.items() if v for x in (k, v)])
    return F.when(code.isin(*valid), code).otherwise(F.try_element_at(remap, code))


def norm_country_sql(expr: str, valid: list[str]) -> str:
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in COUNTRY_REMAP.items() if v)
    codes = ", ".join(f"'{v}'" for v in valid)
    return f"(CASE WHEN upper(trim({expr})) IN ({codes}) THEN upper(trim({expr})) ELSE CASE upper(trim({expr})) {cases} END END)"


def norm_language(c: Column) -> Column:
    """First of slash-separated codes, lower case, remapped; 'und' and '' to null."""
    code = F.lower(F.split_part(c, F.lit("/"), F.lit(1)))
    remap = F.create_map(*[F.lit(x) for pair in LANGUAGE_REMAP.items() for x in pair])
    return F.when(~code.isin("und", ""), F.coalesce(F.try_element_at(remap, code), code))


def norm_currency(currency: Column, funders: Column) -> Column:
    """Currency named by the funder where the code is missing or a bare dollar sign."""
    of = lambda f: F.array_contains(F.coalesce(funders, F.array().cast("array<string>")), f)
    return (
        F.when(currency.isNull() & of("SNSF"), "CHF").when((currency == "$") & of("NHMRC"), "AUD").when(currency == "$", "USD").otherwise(currency)
    )


def fx_table(spark: SparkSession) -> DataFrame:
    """(currency, units_per_eur): a row a currency, small by construction."""
    return spark.createDataFrame(list(UNITS_PER_EUR.items()), "currency string, units_per_eur double")


def with_euros(df: DataFrame, amount: str, currency: str, out: str = "amount_eur") -> DataFrame:
    """``df`` plus the amount in euro: null at 0 or below, above the cap, or without a rate."""
    rates = F.broadcast(fx_table(df.sparkSession)).select(F.col("currency").alias("_cur"), F.col("units_per_eur").alias("_rate"))
    euros = F.col(amount) / F.col("_rate")
    return df.join(rates, F.col(currency) == F.col("_cur"), "left").withColumn(out, F.when((F.col(amount) > 0) & (euros <= MAX_EUR), euros)).drop("_cur", "_rate")


def sane_year(d: Column, first: int = 1950, last: int = 2040) -> Column:
    return F.when(F.year(d).between(first, last), F.year(d))


def sane_date(d: Column, first: int = 1000, last: int = 3000) -> Column:
    return F.when(F.year(d).between(first, last), d)


def not_after(d: Column, today: Column) -> Column:
    """The date, null if it lies in the future; ``today`` is a parameter so that results repeat."""
    return F.when(d <= today, d)
