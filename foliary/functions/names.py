"""Column expressions on case names, case numbers and matter names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .helpers import ratio
from .text import normalize_name

#: Words of case kinds, filler, and markers.
CASE_KINDS = [
    "foreclosure", "identity", "theft", "wrongful", "reporting", "respa", "violation", "chapter", "article", "art", "time", "barred", "debt",
    "appeal", "fcra", "id", "wf", "bankruptcy", "trial", "discovery", "settlement", "consult", "dispute",
]
FILLER = [
    "the", "and", "for", "matter", "case", "client", "new", "york", "ny", "nj", "street", "avenue", "ave", "road", "blvd", "boulevard", "drive",
    "lane", "place", "court", "apt", "suite", "unit", "floor", "brooklyn", "queens", "bronx", "manhattan", "staten", "island", "jamaica", "corona",
    "flushing", "west", "east", "north", "south", "llc", "inc", "corp", "ltd", "co", "index",
]
MARKERS = {
    "prior": "prior", "pror": "prior", "previous": "prior", "appeal": "appeal", "trial": "trial", "art": "articulo15",
    "article": "articulo15", "bankruptcy": "bancarrota", "chapter": "bancarrota", "respa": "respa", "discovery": "discovery",
    "settlement": "settlement", "defend": "defensa",
}
STATE_INDEX = r"(?<![\w.])([1-9]\d{3,6})[-/_](\d{4}|\d{2}(?!,\d))(?!\d)(?!\.\d)"
ZIP4 = r"\b[A-Z]{2}\.?\s+\d{5}-\d{4}\b"
FEDERAL = r"\b(\d)[-:]?(\d{2})-cv-0*(\d{1,6})\b"
E_FILING = r"\bEF\s?0*(\d{1,7})\s*[-/]\s*(\d{4})\b"
ADDRESS = r"\b(\d{1,5}(?:-\d{1,5})?)\s+(?:[NSEW]\.?\s+)?([A-Za-z]{3,})"
FIRST_YEAR, LAST_YEAR = 1990, 2035
EDGES = r"^[\s\-,.;_&]+|[\s\-,.;_&]+$"

empty = lambda: F.array().cast("array<string>")
words = lambda text: F.filter(F.split(text, " "), lambda w: w != "")


def extract_state_indexes(text: Column) -> Column:
    """State case numbers as seq-yyyy, distinct and sorted; dates, ranges and ZIP+4 codes are none."""
    plain = F.regexp_replace(F.coalesce(text, F.lit("")), ZIP4, " ")
    found = F.regexp_extract_all(plain, F.lit("(?U)" + STATE_INDEX), F.lit(0))

    def number(m: Column) -> Column:
        parts = F.split(m, "[-/_]")
        seq, raw = F.get(parts, F.lit(0)).cast("int"), F.get(parts, F.lit(1))
        year = raw.cast("int")
        full = F.when(F.length(raw) == 4, year).when(year <= 35, year + 2000).otherwise(year + 1900)
        bad = seq.between(FIRST_YEAR, LAST_YEAR) | ((F.length(raw) == 4) & ~year.between(FIRST_YEAR, LAST_YEAR))
        return F.when(~bad, F.concat_ws("-", seq.cast("string"), full.cast("string")))

    return F.array_sort(F.array_distinct(F.array_compact(F.transform(found, number))))


def _normal(text: Column, pattern: str, shape: str) -> Column:
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit("(?i)" + pattern), F.lit(0))
    return F.transform(found, lambda m: F.regexp_replace(m, "(?i)" + pattern, shape))


def extract_case_numbers(text: Column) -> Column:
    """State, federal and e-filing numbers, distinct and sorted."""
    other = F.array_union(_normal(text, FEDERAL, "$1-$2-cv-$3"), _normal(text, E_FILING, "EF$1-$2"))
    return F.array_sort(F.array_union(extract_state_indexes(text), other))


def split_case_name(name: Column) -> Column:
    """Struct base, internal_id, index_number, closed."""
    text = F.trim(name)
    front = F.lower(text).startswith("closed - ")
    text = F.when(front, F.substring(text, len("Closed - ") + 1, 100_000)).otherwise(text)
    shape = r"(?s)^(.*) - ((?:(?! - ).)*) - ((?:(?! - ).)*)$"
    part = lambda i: F.trim(F.regexp_extract(text, shape, i))
    whole = part(2).rlike(r"^\d{3,7}$")
    base = F.when(whole, part(1)).otherwise(F.trim(text))
    behind = F.lower(base).endswith(" - closed")
    base = F.when(behind, F.trim(F.left(base, F.greatest(F.length(base) - len(" - Closed"), F.lit(0))))).otherwise(base)
    pick = lambda i: F.when(whole, part(i)).otherwise("")
    return F.struct(base.alias("base"), pick(2).alias("internal_id"), pick(3).alias("index_number"), (front | behind).alias("closed"))


def compose_case_name(base: Column, internal_id: Column, index_number: Column, section: Column) -> Column:
    clean = F.regexp_replace(F.regexp_replace(base, r"\s+", " "), EDGES, "")
    mark = F.when(section == "Closed Matters", " - Closed").otherwise("")
    index = F.when(F.coalesce(index_number, F.lit("")) == "", "0").otherwise(index_number)
    return F.concat(clean, mark, F.lit(" - "), internal_id.cast("string"), F.lit(" - "), index)


def address_keys(name: Column) -> Column:
    """House number and first six letters of the street, distinct and sorted."""
    plain = F.regexp_replace(F.coalesce(name, F.lit("")), r"\d+\s*/\s*\d+[A-Za-z]?", " ")
    found = F.regexp_extract_all(plain, F.lit(ADDRESS), F.lit(0))

    def key(m: Column) -> Column:
        street = F.lower(F.regexp_extract(m, ADDRESS, 2))
        house = F.replace(F.regexp_extract(m, ADDRESS, 1), F.lit("-"), F.lit(""))
        return F.when(~street.isin(FILLER) | street.isin("street", "avenue"), F.concat(house, F.left(street, F.lit(6))))

    return F.array_sort(F.array_distinct(F.array_compact(F.transform(found, key))))


def matter_markers(name: Column) -> Column:
    table = F.create_map(*[F.lit(x) for kv in MARKERS.items() for x in kv])
    return F.array_sort(F.array_distinct(F.array_compact(F.transform(words(normalize_name(name)), lambda w: table[w]))))


def person_tokens(name: Column) -> Column:
    keep = lambda w: (F.length(w) >= 3) & ~w.rlike("^[0-9]+$") & ~w.isin(CASE_KINDS + FILLER + list(MARKERS))
    return F.array_sort(F.array_distinct(F.filter(words(normalize_name(name)), keep)))


def descriptor_tokens(name: Column, client: Column) -> Column:
    """What a matter's name says beyond its client and the kind of case."""
    prefix = F.get(F.split(F.coalesce(name, F.lit("")), r"\s-\s|\("), F.lit(0))
    own = F.array_union(words(normalize_name(client)), words(normalize_name(prefix)))
    keep = lambda w: ~w.isin(CASE_KINDS + FILLER) & ((F.length(w) >= 3) | w.rlike("^[0-9]+$"))
    return F.array_sort(F.array_distinct(F.filter(F.array_except(words(normalize_name(name)), own), keep)))


def is_generic_matter(name: Column, client: Column) -> Column:
    return (F.size(descriptor_tokens(name, client)) == 0) & (F.size(extract_state_indexes(name)) == 0) & (F.size(address_keys(name)) == 0)


def name_in_matter(title: Column) -> Column:
    """The first part that names a person or a company, '' if none."""
    parts = F.transform(F.split(F.coalesce(title, F.lit("")), " - "), F.trim)
    # a vectorised helper can't run inside a lambda, so accents go by a table here
    found = F.filter(parts, lambda p: (F.size(_person_ascii(p)) >= 2) | _company_ascii(p))
    return F.coalesce(F.get(found, F.lit(0)), F.lit(""))


def _ascii_words(p: Column) -> Column:
    return words(F.trim(F.regexp_replace(F.lower(F.translate(p, _ACCENTED, _PLAIN)), "[^a-z0-9]+", " ")))


_ACCENTED, _PLAIN = "áàâäãåéèêëíìîïóòôöõúùûüñçÁÀÂÄÃÅÉÈÊËÍÌÎÏÓÒÔÖÕÚÙÛÜÑÇ", "aaaaaaeeeeiiiiooooouuuuncAAAAAAEEEEIIIIOOOOOUUUUNC"


def _person_ascii(p: Column) -> Column:
    keep = lambda w: (F.length(w) >= 3) & ~w.rlike("^[0-9]+$") & ~w.isin(CASE_KINDS + FILLER + list(MARKERS))
    return F.array_distinct(F.filter(_ascii_words(p), keep))


def _company_ascii(p: Column) -> Column:
    w = _ascii_words(p)
    return (F.size(w) >= 3) & F.element_at(w, -1).isin("llc", "inc", "corp", "ltd")


def name_similarity(a: Column, b: Column) -> Column:
    """The better of the similarities of two normalized names and of their sorted words."""
    x, y = normalize_name(a), normalize_name(b)
    ordered = lambda t: F.concat_ws(" ", F.array_sort(words(t)))
    return F.greatest(ratio(x, y), ratio(ordered(x), ordered(y)))


def folder_surnames(folder: Column) -> Column:
    """Words of more than two letters before a folder name's comma."""
    base = F.when(folder.contains(","), F.substring_index(folder, ",", 1)).otherwise(folder)
    return F.array_distinct(F.filter(words(normalize_name(F.regexp_replace(base, r"[.\-_&]", " "))), lambda w: F.length(w) > 2))


def client_tokens(person: Column) -> Column:
    """Words of a person's name that may be a surname: any of more than two, else the last."""
    own = F.filter(words(normalize_name(person)), lambda w: F.length(w) > 2)
    return F.when(F.size(own) > 2, own).when(F.size(own) == 0, empty()).otherwise(F.slice(own, -1, 1))


def one_char_apart(a: Column, b: Column) -> Column:
    return F.levenshtein(a, b) == 1
