"""Column-to-column helpers; all are compositions of Spark built-ins."""

from tidings.functions.codes import root_code
from tidings.functions.dates import file_date, file_stem
from tidings.functions.terms import contains_any
from tidings.functions.urls import country_from_tld, domain_of

__all__ = ["contains_any", "country_from_tld", "domain_of", "file_date", "file_stem", "root_code"]
