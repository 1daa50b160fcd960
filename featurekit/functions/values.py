"""Fixed value lists and the lookups that use them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Browser versions that count as recent.
LATEST_BROWSERS = [
    "samsung browser 7.0",
    "opera 53.0",
    "mobile safari 10.0",
    "google search application 49.0",
    "firefox 60.0",
    "edge 17.0",
    "chrome 69.0",
    "chrome 67.0 for android",
    "chrome 63.0 for android",
    "chrome 63.0 for ios",
    "chrome 64.0",
    "chrome 64.0 for android",
    "chrome 64.0 for ios",
    "chrome 65.0",
    "chrome 65.0 for android",
    "chrome 65.0 for ios",
    "chrome 66.0",
    "chrome 66.0 for android",
    "chrome 66.0 for ios",
]

# Mail domain to provider.
EMAIL_PROVIDERS = {
    "gmail": "google", "att.net": "att", "twc.com": "spectrum", "scranton.edu": "other",
    "optonline.net": "other", "hotmail.co.uk": "microsoft", "comcast.net": "other", "yahoo.com.mx": "yahoo",
    "yahoo.fr": "yahoo", "yahoo.es": "yahoo", "charter.net": "spectrum", "live.com": "microsoft",
    "aim.com": "aol", "hotmail.de": "microsoft", "centurylink.net": "centurylink", "gmail.com": "google",
    "me.com": "apple", "earthlink.net": "other", "gmx.de": "other", "web.de": "other", "cfl.rr.com": "other",
    "hotmail.com": "microsoft", "protonmail.com": "other", "hotmail.fr": "microsoft",
    "windstream.net": "other", "outlook.es": "microsoft", "yahoo.co.jp": "yahoo", "yahoo.de": "yahoo",
    "servicios-ta.com": "other", "netzero.net": "other", "suddenlink.net": "other", "roadrunner.com": "other",
    "sc.rr.com": "other", "live.fr": "microsoft", "verizon.net": "yahoo", "msn.com": "microsoft",
    "q.com": "centurylink", "prodigy.net.mx": "att", "frontier.com": "yahoo", "anonymous.com": "other",
    "rocketmail.com": "yahoo", "sbcglobal.net": "att", "frontiernet.net": "yahoo", "ymail.com": "yahoo",
    "outlook.com": "microsoft", "mail.com": "other", "bellsouth.net": "other",
    "embarqmail.com": "centurylink", "cableone.net": "other", "hotmail.es": "microsoft", "mac.com": "apple",
    "yahoo.co.uk": "yahoo", "netzero.com": "other", "yahoo.com": "yahoo", "live.com.mx": "microsoft",
    "ptd.net": "other", "cox.net": "other", "aol.com": "aol", "juno.com": "other", "icloud.com": "apple",
}

# Codes of the flag-like identity columns.
TRUE_FALSE = {"T": 1, "F": 0}
FOUND = {"Found": 1, "NotFound": 0}
NEW_FOUND_UNKNOWN = {"New": 2, "Found": 1, "Unknown": 0}
NEW_FOUND = {"New": 2, "Found": 1}
PROXY = {"TRANSPARENT": 4, "IP_PROXY": 3, "IP_PROXY:ANONYMOUS": 2, "IP_PROXY:HIDDEN": 1}
DEVICE_TYPE = {"desktop": 1, "mobile": 0}


def known_value_flag(column: Column, known: Sequence[str]) -> Column:
    """1 when the value is listed, otherwise (also for null) 0."""
    return F.coalesce(column.isin(list(known)).cast("int"), F.lit(0))


def constant_map(column: Column, mapping: Mapping) -> Column:
    """Look a value up in a small fixed mapping; null when it is not listed."""
    pairs = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return F.try_element_at(pairs, column)
