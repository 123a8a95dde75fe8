"""Business rules as column expressions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# Fixed values ---------------------------------------------------------------
# Overdue buckets: name, regulatory grade, last day of the bucket.
OVERDUE_BUCKETS = (
    ("AL_DIA", "A", 0),
    ("RANGO_1", "B", 30),
    ("RANGO_2", "C", 60),
    ("RANGO_3", "D", 90),
    ("DETERIORADO", "E", None),
)
BUCKET_NAMES = tuple(name for name, _, _ in OVERDUE_BUCKETS)
# Provision share of the balance per regulatory grade, in percent.
PROVISION_PCT = {"A": 1, "B": 3, "C": 20, "D": 50, "E": 100}
SEGMENT_LABELS = {
    "BASICO": "Básico (< 2 SMLV)",
    "ESTANDAR": "Estándar (2-5 SMLV)",
    "PREMIUM": "Premium (5-15 SMLV)",
    "ELITE": "Elite (> 15 SMLV)",
}
CHANNEL_LABELS = {
    "APP_MOVIL": "Aplicación Móvil",
    "PORTAL_WEB": "Portal Web",
    "CORRESPONSAL": "Corresponsal Bancario",
    "ATM": "Cajero Automático",
    "BANCA_TELEFONICA": "Banca Telefónica",
    "SUCURSAL": "Sucursal Física",
}
SCORE_BANDS = ((400, "BAJO"), (600, "MEDIO"), (800, "ALTO"))
TOP_SCORE_BAND = "MUY_ALTO"
COP_TO_USD = 1 / 4100
DAYS_PER_YEAR = 365.25
WORKING_DAYS = (2, 3, 4, 5, 6)  # Monday to Friday in dayofweek numbering
WORKING_HOURS = (6, 19)
# -----------------------------------------------------------------------------

# Amounts are exact to the cent below this limit; silver rejects what reaches it.
MONEY = DecimalType(24, 2)
MONEY_LIMIT = 1e22


def money(value) -> Column:
    """Exact amount in cents precision, for use inside products and sums."""
    return _col(value).cast(MONEY)


def beyond_money(value) -> Column:
    """True for amounts that `money` cannot hold, among them NaN and infinity; NULL is none of them."""
    return F.coalesce(~(F.abs(_col(value)) < F.lit(MONEY_LIMIT)), F.lit(False))


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0 (also for NULL)."""
    return F.when(condition, 1).otherwise(0)


def label(value, mapping: dict[str, str]) -> Column:
    """Look a code up in a small fixed mapping; an unknown code gives NULL."""
    entries = [F.lit(part) for pair in mapping.items() for part in pair]
    return F.create_map(*entries)[_col(value)]


def clamp_min(value, low) -> Column:
    """Raise values below `low` to it; NULL stays NULL."""
    return F.when(_col(value) < low, F.lit(low)).otherwise(_col(value))


def _bucket_index(days) -> Column:
    """Position in OVERDUE_BUCKETS. NULL and negative days count as up to date."""
    days = F.coalesce(_col(days), F.lit(0))
    uppers = [upper for _, _, upper in OVERDUE_BUCKETS if upper is not None]
    return sum((flag(days > upper) for upper in uppers), F.lit(0))


def bucket_order(days) -> Column:
    return _bucket_index(days).cast("int")


def overdue_bucket(days) -> Column:
    names = F.array(*[F.lit(name) for name in BUCKET_NAMES])
    return F.get(names, _bucket_index(days))


def risk_grade(days) -> Column:
    grades = F.array(*[F.lit(grade) for _, grade, _ in OVERDUE_BUCKETS])
    return F.get(grades, _bucket_index(days))


def provision(balance, grade) -> Column:
    """Balance times the share of its grade, to the cent."""
    shares = [part for code, pct in PROVISION_PCT.items()
              for part in (F.lit(code), F.lit(pct).cast(DecimalType(3, 0)))]
    share = F.create_map(*shares)[_col(grade)]
    return F.round(money(balance) * share * F.lit("0.01").cast(DecimalType(3, 2)), 2).cast("double")


def channel_label(code) -> Column:
    return F.coalesce(label(code, CHANNEL_LABELS), _col(code))


def score_band(score) -> Column:
    """Band of a bureau score; a missing score falls in the top band, as in the analyst view."""
    chain = F
    for below, name in SCORE_BANDS:
        chain = chain.when(_col(score) < below, F.lit(name))
    return chain.otherwise(F.lit(TOP_SCORE_BAND))


def to_usd(amount, rate: float = COP_TO_USD) -> Column:
    return F.round(_col(amount) * F.lit(float(rate)), 4)


def monthly_rate(annual_pct) -> Column:
    """Monthly equivalent, in percent, of an effective annual rate in percent."""
    growth = F.pow(_col(annual_pct) / 100.0 + 1, F.lit(1.0 / 12.0))
    return F.round((growth - 1) * 100, 4)


def age_years(born, as_of: date) -> Column:
    return F.floor(F.datediff(F.lit(as_of), _col(born)) / DAYS_PER_YEAR).cast("int")


def business_hours(day, hour_text) -> Column:
    """1 on Monday to Friday from 06:00 to 19:59, else 0."""
    hour = F.hour(F.try_to_timestamp(_col(hour_text), F.lit("HH:mm:ss")))
    return flag(F.dayofweek(_col(day)).isin(*WORKING_DAYS) & hour.between(*WORKING_HOURS))


def period(day) -> Column:
    return F.date_format(_col(day), "yyyy-MM")


def in_trailing_months(day, months: int, as_of: date) -> Column:
    """True from the day so many months before `as_of` to `as_of`."""
    return _col(day).between(F.add_months(F.lit(as_of), -months), F.lit(as_of))


def safe_pct(part, whole, scale: int = 4) -> Column:
    """part / whole in percent, 0 where there is no positive whole."""
    ratio = F.when(_col(whole) > 0, _col(part) / _col(whole) * 100).otherwise(F.lit(0.0))
    return F.round(ratio, scale)


def sum_if(value, condition: Column) -> Column:
    return F.sum(F.when(condition, _col(value)).otherwise(F.lit(0)))


def count_distinct_if(key, condition: Column) -> Column:
    return F.countDistinct(F.when(condition, _col(key)))


def sha256_hex(value) -> Column:
    """SHA-256 of the text form; NULL stays NULL."""
    return F.sha2(_col(value).cast("string"), 256)


def _col(value) -> Column:
    return value if isinstance(value, Column) else F.col(value)
