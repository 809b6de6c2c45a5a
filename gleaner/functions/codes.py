"""Code mapping of job fields. The fixed maps are literals; a site's own map is a dict or a lookup table."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleaner.functions.text import clean_special_chars, each, literal_map, remove_words, strip

# Job type codes.
JOB_TYPES = {
    "fulltime": "FULL_TIME",
    "parttime": "PART_TIME",
    "full time": "FULL_TIME",
    "part time": "PART_TIME",
    "f": "FULL_TIME",
    "p": "PART_TIME",
    "c": "CONTRACT",
    "t": "TEMPORARY",
    "o": "OTHER",
}

# Experience level codes.
EXPERIENCE_LEVELS = {
    "0": "NOT_APPLICABLE",
    "1": "INTERNSHIP",
    "2": "ENTRY_LEVEL",
    "3": "ASSOCIATE",
    "4": "MID_SENIOR_LEVEL",
    "5": "DIRECTOR",
    "6": "EXECUTIVE",
}

# Job function codes.
FUNCTIONS = {
    "none": "",
    "accounting/auditing": "ACCT",
    "administrative": "ADMN",
    "advertising": "ADVR",
    "analyst": "ANLS",
    "art/creative": "ART",
    "businessdevelopment": "BD",
    "consulting": "CNSL",
    "customerservice": "CUST",
    "distribution": "DIST",
    "design": "DSGN",
    "education": "EDU",
    "engineering": "ENG",
    "finance": "FIN",
    "generalbusiness": "GENB",
    "healthcareprovider": "HCPR",
    "humanresources": "HR",
    "informationtechnology": "IT",
    "legal": "LGL",
    "management": "MGMT",
    "manufacturing": "MNFC",
    "marketing": "MRKT",
    "other": "OTHR",
    "publicrelations": "PR",
    "purchasing": "PRCH",
    "productmanagement": "PRDM",
    "projectmanagement": "PRJM",
    "production": "PROD",
    "qualityassurance": "QA",
    "research": "RSCH",
    "sales": "SALE",
    "science": "SCI",
    "strategy/planning": "STRA",
    "supplychain": "SUPL",
    "training": "TRNG",
    "writing/editing": "WRT",
}

# Industry codes.
INDUSTRIES = {"retail": 47}

MAX_CODES = 3


def lookup(key: Column, mapping: Mapping[str, str]) -> Column:
    return F.try_element_at(literal_map(mapping), key)


def clean_field(values: Column, remove: Sequence[str] = ()) -> Column:
    """What a value looks like when it is looked up: words removed, other characters blanked."""
    return clean_special_chars(F.transform(values, remove_words(remove)))


def map_job_field(values: Column, mapping: Mapping[str, str], remove: Sequence[str] = ()) -> Column:
    """Code of each value, or the cleaned value in upper case."""
    return F.transform(
        clean_field(values, remove), lambda v: F.coalesce(lookup(F.lower(v), mapping), F.upper(v))
    )


def map_job_types(values: Column, remove: Sequence[str] = ()) -> Column:
    return map_job_field(values, JOB_TYPES, remove)


def map_experience_level(values: Column, remove: Sequence[str] = ()) -> Column:
    return map_job_field(values, EXPERIENCE_LEVELS, remove)


def _squeeze(text: str) -> str:
    return "".join(c for c in text if c.isascii() and c.isalnum())


def map_functions(values: Column, mapping: Mapping[str, str] = FUNCTIONS, remove: Sequence[str] = ()) -> Column:
    """JSON array of the first three function codes; keys match whatever punctuation either side uses."""
    keys = {_squeeze(k.lower()): code for k, code in mapping.items()}
    codes = F.transform(
        clean_field(values, remove),
        lambda v: F.coalesce(lookup(F.regexp_replace(F.lower(v), "[^a-z0-9]", ""), keys), F.upper(v)),
    )
    return F.to_json(F.slice(F.filter(codes, lambda c: c != ""), 1, MAX_CODES))


def industry_codes(values: Column, mapping: Mapping[str, int | str] = INDUSTRIES, splitter: str = ",", most: int = MAX_CODES) -> Column:
    """The first industries as `array<variant>`: the code, a number or a text, where it is known, else the text itself."""
    pieces = F.flatten(F.transform(values, lambda v: F.split(v, r"\Q" + splitter + r"\E")))
    pieces = F.slice(F.filter(each(strip)(pieces), lambda p: p != ""), 1, most)
    codes = {k: json.dumps(code) for k, code in mapping.items()}
    return F.transform(pieces, lambda p: F.coalesce(F.parse_json(lookup(F.lower(p), codes)), p.cast("variant")))


def map_industries(
    values: Column, mapping: Mapping[str, int | str] = INDUSTRIES, splitter: str = ",", most: int = MAX_CODES
) -> Column:
    """JSON array of the first three industries: the code where known, else the text itself."""
    return F.to_json(industry_codes(values, mapping, splitter, most))
