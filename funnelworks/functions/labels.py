"""Label normalisation and the small business vocabularies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import col

# Allowed members and region spellings found in the exports.
COMPANY_SIZES = ["1-9", "10-49", "50+"]
PLANS = ["Starter", "Pro", "Group"]
STAGES = ["Won", "Lost", "Open"]
REGION_SYNONYMS = {
    "bruxelles": "Brussels",
    "brussel": "Brussels",
    "anvers": "Antwerp",
    "antwerpen": "Antwerp",
    "liege": "Liège",
    "luik": "Liège",
    "oost-vlaanderen": "East Flanders",
    "flandre orientale": "East Flanders",
    "vlaams-brabant": "Flemish Brabant",
    "brabant wallon": "Walloon Brabant",
    "henegouwen": "Hainaut",
    "namen": "Namur",
}

# (?U) makes \s cover no-break and other Unicode spaces; the four separators are added by hand.
_SPACES = r"(?U)[\s\x1c-\x1f]+"


def strip_spaces(label: str | Column) -> Column:
    return F.trim(F.regexp_replace(col(label), rf"^{_SPACES}|{_SPACES}$", ""))


def norm(label: str | Column) -> Column:
    """What two spellings of one label have in common: neither case nor the amount and kind of blanks count."""
    return F.trim(F.regexp_replace(F.lower(col(label)), _SPACES, " "))


def score_band(score: str | Column) -> Column:
    """The bands of the report."""
    s = col(score)
    return (
        F.when(s.isNull(), "Unknown")
        .when(s >= 80, "80-100")
        .when(s >= 60, "60-79")
        .when(s >= 40, "40-59")
        .otherwise("0-39")
    )


def paid_label(is_paid: str | Column) -> Column:
    return F.when(col(is_paid) == 1, "Paid").otherwise("Non-paid")
