"""E-mail, phone and postal-code rules."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparktidy import rulepack
from sparktidy.functions.rule import Rule, only_if
from sparktidy.functions.text import clean_text


def _replace_endings(value: Column, endings: Mapping[str, str]) -> Column:
    """Literal replacement at the end of the text only, of the longest ending that fits, once."""
    out = value
    for old, new in sorted(endings.items(), key=lambda e: len(e[0])):
        stem = F.left(value, F.length(value) - len(old))
        out = F.when(F.endswith(value, F.lit(old)), F.concat(stem, F.lit(new))).otherwise(out)
    return out


def email_rule(
    domain_typos: Mapping[str, str] = rulepack.EMAIL_DOMAIN_TYPOS,
    pattern: str = rulepack.EMAIL_PATTERN,
) -> Rule:
    """Lower-case, drop spaces, repair known domain typos; null unless the result is an address."""
    endings = {f"@{wrong}": f"@{right}" for wrong, right in domain_typos.items()}
    return Rule(
        "normalize_email",
        clean_text,
        lambda v: _replace_endings(F.replace(F.lower(v), F.lit(" "), F.lit("")), endings),
        lambda v: only_if(v, pattern),
    )


normalize_email = email_rule()


def _without_float_tail(value: Column) -> Column:
    return _replace_endings(value, {".0": ""})


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def phone_rule(country: str = "48", groups: tuple[int, ...] = (3, 3, 3)) -> Rule:
    """Digits with an optional ``00cc`` or ``cc`` prefix -> ``+cc ddd ddd ddd``, else null."""
    national = "".join(f"([0-9]{{{n}}})" for n in groups)
    shown = " ".join([f"+{country}", *[f"${i + 1}" for i in range(len(groups))]])
    return Rule(
        "normalize_phone",
        clean_text,
        lambda v: F.regexp_replace(
            _digits(_without_float_tail(v)), f"^(?:(?:00)?{country})?{national}$", shown
        ),
        lambda v: only_if(v, "^\\+.*"),
    )


normalize_phone_pl = phone_rule()

# only a text made of digits alone can be a number that lost its leading zeros
normalize_postal_code_pl = Rule(
    "normalize_postal_code",
    clean_text,
    _without_float_tail,
    lambda v: F.regexp_replace(v, "^([0-9]{4})$", "0$1"),
    lambda v: F.regexp_replace(v, "^([0-9]{3})$", "00$1"),
    _digits,
    lambda v: F.regexp_replace(only_if(v, "^[0-9]{5}$"), "^(..)", "$1-"),
)
