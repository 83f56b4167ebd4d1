"""Publisher domain and country from an article address."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Countries by the last label of the host name.
COUNTRY_BY_LAST_LABEL: dict[str, str] = {
    "ca": "Canada",
    "uk": "United Kingdom",
    "au": "Australia",
    "de": "Germany",
    "fr": "France",
    "jp": "Japan",
    "cn": "China",
    "in": "India",
    "ru": "Russia",
    "es": "Spain",
    "nz": "New Zealand",
    "gov": "United States",
    "edu": "United States",
    "mil": "United States",
}


# The host starts behind the first scheme that is not followed by a slash at once. One leading
# "www." is passed over, and a colon ends the name only where nothing but digits follows it.
_DOMAIN = r"https?://(?=[^/])(?:www\.)?([^/:]*+(?::(?!\d+(?![^/]))[^/:]*+)*+)"


def domain_of(url: Column | str) -> Column:
    """Host name of ``url`` without one leading ``www.`` and without a trailing port.

    Case and user information stay as they are; no scheme gives '' and NULL gives NULL. The
    address is matched once: every further expression over it is evaluated for every event.
    """
    return F.regexp_extract(url, _DOMAIN, 1)


def country_from_tld(domain: Column | str) -> Column:
    """Country suggested by the last label of ``domain``; NULL where there is no rule.

    Case-sensitive, and a host without a dot has no last label.
    """
    host = F.col(domain) if isinstance(domain, str) else domain
    label = F.substring_index(host, ".", -1)
    rules = F.create_map(*[F.lit(text) for rule in COUNTRY_BY_LAST_LABEL.items() for text in rule])
    return F.when(F.contains(host, F.lit(".")), F.try_element_at(rules, label))
