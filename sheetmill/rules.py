"""Format rules: which texts count as dates and numbers, and how dates are read."""

from __future__ import annotations

from dataclasses import dataclass

# Java regular expressions, always used with ``rlike``. ``[0-9]`` and ``\z`` keep out
# non-ASCII digits and a trailing newline.

# What makes a cell a date or a number when types are inferred. A number with
# a decimal point or a percent sign is FLOAT, any other INT64.
DATE_LABEL = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
NUMERIC_LABEL = r"^[0-9]+(\.[0-9]+)?%?\z"
# What a typed column accepts, and the looser numeric test of the reject side.
DATE_FORMAT = r"^([0-9]{1,2}-[A-Za-z]{3}-[0-9]{4}|[0-9]{1,2}/[0-9]{1,2}/([0-9]{2}|[0-9]{4}))\z"
NUMERIC_FORMAT = r"^[0-9]+(\.[0-9]+)?%?\z"
NUMERIC_FORMAT_REJECT = r"^[0-9,]+(\.[0-9]+)?%?\z"
# Fixed value: the zone of ``load_datetime``.
LOAD_ZONE = "Asia/Jakarta"
# Reject reasons.
DATATYPE_MISMATCH = "DATATYPE MISMATCH"
SURPLUS_CELLS = "SURPLUS CELLS"
DUPLICATE_RECORD = "DUPLICATE RECORD"

ALIGNED_DATE = (
    r"^([0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}-[A-Za-z]{3}-[0-9]{4}"
    r"|[0-9]{1,2}/[0-9]{1,2}/([0-9]{2}|[0-9]{4}))\z"
)
ALIGNED_NUMERIC = r"^([0-9]+|[0-9]{1,3}(,[0-9]{3})+)(\.[0-9]+)?%?\z"


@dataclass(frozen=True)
class DateReader:
    """A date shape and the datetime pattern that reads it."""

    shape: str
    pattern: str
    short_year: bool = False


MDY = DateReader(r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}\z", "M/d/yyyy")
MDY_SHORT = DateReader(r"^[0-9]{1,2}/[0-9]{1,2}/[0-9]{2}\z", "M/d/yyyy", short_year=True)
D_MON_Y = DateReader(r"^[0-9]{1,2}-[A-Za-z]{3}-[0-9]{4}\z", "d-MMM-yyyy")
ISO = DateReader(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z", "yyyy-MM-dd")


@dataclass(frozen=True)
class RuleSet:
    """Patterns used to infer, accept, reject and read cells."""

    label_date: str
    label_numeric: str
    accept_date: str
    accept_numeric: str
    reject_date: str
    reject_numeric: str
    date_readers: tuple[DateReader, ...]

    @classmethod
    def reference(cls) -> RuleSet:
        """The default rules, contradictions included.

        A column is called a date by its ISO values, yet ISO values fail the date format;
        ``d-Mon-yyyy`` passes the format but reads as NULL; ``1,234`` is neither accepted
        nor rejected.
        """
        return cls(
            label_date=DATE_LABEL,
            label_numeric=NUMERIC_LABEL,
            accept_date=DATE_FORMAT,
            accept_numeric=NUMERIC_FORMAT,
            reject_date=DATE_FORMAT,
            reject_numeric=NUMERIC_FORMAT_REJECT,
            date_readers=(MDY, MDY_SHORT),
        )

    @classmethod
    def aligned(cls) -> RuleSet:
        """One shared pattern per group, so every row is accepted or rejected and every
        accepted shape can be read."""
        return cls(
            label_date=ALIGNED_DATE,
            label_numeric=ALIGNED_NUMERIC,
            accept_date=ALIGNED_DATE,
            accept_numeric=ALIGNED_NUMERIC,
            reject_date=ALIGNED_DATE,
            reject_numeric=ALIGNED_NUMERIC,
            date_readers=(MDY, MDY_SHORT, D_MON_Y, ISO),
        )
