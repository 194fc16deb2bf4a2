"""Text and label functions: expressions from Column to Column. Null gives null unless said otherwise."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ridgeline.functions import vocabulary as V


def folded_replace(text: Column, pairs: list[tuple[str, str]]) -> Column:
    return reduce(lambda c, p: F.replace(c, F.lit(p[0]), F.lit(p[1])), pairs, text)


def label_key(text: Column) -> Column:
    """Key under which spellings of one label meet: entities and tags off, scripts and Greek folded, [a-z0-9@/] kept."""
    plain = F.lower(F.regexp_replace(folded_replace(text, V.ENTITIES), V.MARKUP, ""))
    return F.coalesce(F.regexp_replace(folded_replace(F.translate(plain, *V.SCRIPTS), V.GREEK), "[^a-z0-9@/]", ""), F.lit(""))


def key_patterns() -> dict[str, str]:
    """Patterns over label keys, from the word lists."""
    some = lambda words: "(" + "|".join(words) + ")"
    framework = some(V.FRAMEWORKS)
    return {
        "generic": f"^{some(V.ADJECTIVES)}?{framework}{some(V.FORMS)}?$",
        "serial": f"^({some(V.FRAMEWORKS)}|{some(V.COUNTERS)})([0-9]{{1,2}}[a-z]?|[a-z][0-9]{{1,2}}|[a-z]{{1,3}})$",
        "paper_local": f"^[a-z]{{1,3}}[0-9]{{0,2}}{framework}([a-z]?[0-9]{{1,2}})?$",
    }


def specificity(key: Column) -> Column:
    """paper_local (too short), generic, serial, paper_local or specific; the first rule that holds."""
    patterns = key_patterns()
    rules = F.when(F.coalesce(F.length(key), F.lit(0)) < V.SHORTEST_KEY, "paper_local").when(key.isin(V.GENERIC), "generic")
    return reduce(lambda c, p: c.when(key.rlike(p[1]), p[0]), patterns.items(), rules).otherwise("specific")


def published(text: Column) -> Column:
    """White space as single spaces, trimmed; empty gives null."""
    return F.nullif(F.trim(F.regexp_replace(text, r"\s+", " ")), F.lit(""))


def doi(text: Column) -> Column:
    return F.regexp_replace(F.lower(F.trim(text)), r"^https?://(dx\.)?doi\.org/", "")


def identity_key(text: Column) -> Column:
    """The DOI with its first slash as an underscore."""
    return F.regexp_replace(doi(text), "^([^/]*)/", "$1_")


def name_key(text: Column) -> Column:
    return F.regexp_replace(F.lower(text), "[^a-z0-9]", "")


def doi_in_name(name: Column) -> Column:
    """DOI in a file name, underscores as slashes; null if there is none."""
    found = F.regexp_extract(name, V.DOI_IN_NAME, 1)
    return F.when(found != "", F.translate(found, "_", "/"))


def slug(text: Column, fallback: str = "item") -> Column:
    plain = F.regexp_replace(F.regexp_replace(F.lower(F.trim(text)), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.when(plain == "", fallback).otherwise(plain)


def keyword_score(text: Column, keywords: list[tuple[str, float]] = V.KEYWORDS + V.KEYWORDS_AGAINST) -> Column:
    """Sigmoid of the summed weights of the keywords present, for and against."""
    low = F.lower(text)
    total = reduce(lambda a, b: a + b, [F.when(F.contains(low, F.lit(k)), w).otherwise(0.0) for k, w in keywords])
    return 1.0 / (1.0 + F.exp(-total))


def figure_label(text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, r"(?i)\b(fig(?:ure)?\.?\s*[0-9]+[a-z]?)", 1), F.lit(""))


def numeric_token(token: Column) -> Column:
    """A scanned number with common misreadings repaired: letters for digits, comma for point, doubled points and signs."""
    t = F.regexp_replace(F.translate(F.trim(token), V.MISREAD[0] + V.MISREAD_GONE, V.MISREAD[1]), "[^0-9.-]", "")
    dot = F.instr(t, ".")
    t = F.when(F.regexp_count(t, F.lit("[.]")) > 1, F.concat(F.left(t, dot), F.replace(F.substr(t, dot + 1), F.lit("."), F.lit("")))).otherwise(t)
    t = F.when(F.regexp_count(t, F.lit("-")) > 1, F.concat(F.lit("-"), F.replace(t, F.lit("-"), F.lit("")))).otherwise(t)
    return F.regexp_replace(F.regexp_replace(t, r"^\.", "0."), r"^-\.", "-0.")


def numeric_value(token: Column) -> Column:
    t = numeric_token(token)
    return F.when(t.rlike(r"^-?[0-9]+(\.[0-9]+)?$"), t.try_cast("double"))


def axis_label(text: Column) -> Column:
    t = F.translate(folded_replace(F.lower(text), V.AXIS_WORDS), "-_", "  ")
    return F.trim(F.regexp_replace(F.regexp_replace(t, r"[^a-z0-9(). ]+", " "), r"\s+", " "))


def angle_axis(text: Column) -> Column:
    """Whether an axis label or its ticks speak of a diffraction angle: by name, by ticks 5 or 10 apart, or by a degree with a 2."""
    t = axis_label(text)
    numbers = F.transform(F.regexp_extract_all(t, F.lit(r"\b([0-9]{1,2})\b"), F.lit(1)), lambda x: x.cast("int"))
    rest = F.greatest(F.size(numbers) - 1, F.lit(0))
    steps = F.zip_with(F.slice(numbers, F.lit(2), rest), F.slice(numbers, F.lit(1), rest), lambda b, a: b - a)
    apart = lambda k: F.size(F.filter(steps, lambda d: d == k)) >= 2
    named = t.rlike(r"two theta|\b2\s*theta\b|\b2\s*t[hx][a-z]{0,4}\b")
    degree = t.rlike(r"\bdeg(ree)?\b") & t.rlike(r"\b2\b|\b2.{0,10}deg|\b2\s*0\b")
    return (t != "") & (named | ((F.size(numbers) >= 3) & (apart(5) | apart(10))) | degree)


def without_controls(text: Column) -> Column:
    """Without control, zero-width and private-use characters."""
    return F.regexp_replace(text, r"[\x00-\x08\x0B-\x1F\x7F-\x9F\x{200B}-\x{200F}\x{FEFF}\x{E000}-\x{F8FF}]", "")


def title(text: Column) -> Column:
    """White space folded, hyphens at line ends joined again, trailing asterisks off."""
    return F.regexp_replace(F.regexp_replace(F.trim(F.regexp_replace(text, r"\s+", " ")), r"([a-z])- ([a-z])", "$1$2"), r"[\s*]+$", "")


def usable_title(text: Column) -> Column:
    t = F.trim(text)
    letters, words = F.regexp_count(t, F.lit("[A-Za-z]")), F.size(F.split(t, r"\s+"))
    low = F.lower(t)
    bad = t.rlike(V.TITLE_DOI) | t.rlike(V.TITLE_PAGE_RANGE) | low.rlike(V.TITLE_FILES) | low.rlike("|".join(V.TITLE_BAD))
    return F.length(t).between(20, 500) & (letters >= 10) & (words >= 4) & ~bad


def divergence(local: Column, other: Column) -> Column:
    """How two titles differ: identical, whitespace, punctuation, local_mojibake or material."""
    tight = lambda x: F.regexp_replace(x, r"\s+", "")
    fold = lambda x: F.lower(F.regexp_replace(x, r"[^\p{L}\p{N}]+", ""))
    broken = lambda x: x.rlike(V.MOJIBAKE)
    return F.when(local == other, "identical").when(tight(local) == tight(other), "whitespace").when(fold(local) == fold(other), "punctuation").when(broken(local) & ~broken(other), "local_mojibake").otherwise("material")


def authors(people: Column, most: int = 12) -> Column:
    """array<struct<name, given, family, suffix>> as text; more than `most` are cut with ' et al.'"""
    names = F.transform(people, lambda p: F.coalesce(F.nullif(F.trim(p["name"]), F.lit("")), F.nullif(F.concat_ws(" ", p["given"], p["family"], p["suffix"]), F.lit(""))))
    names = F.filter(names, lambda n: n.isNotNull())
    return F.nullif(F.when(F.size(names) > most, F.concat(F.array_join(F.slice(names, 1, most), ", "), F.lit(" et al."))).otherwise(F.array_join(names, ", ")), F.lit(""))


def without_stamp(text: Column) -> Column:
    return F.regexp_replace(text, V.TITLE_STAMP, "")


def is_notice(text: Column) -> Column:
    return text.rlike(V.NOTICE_TITLE)


def stacking(text: Column) -> Column:
    low = F.lower(text)
    return F.when(low.rlike(r"\baa\b|eclips"), "AA / eclipsed").when(low.rlike(r"\bab\b|stagger"), "AB / staggered")


def treated(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).rlike(V.TREATED)


def applications(text: Column) -> Column:
    """Sorted application classes of a list parted by ; or , (each part counts for the first class that marks it)."""
    parts = F.filter(F.transform(F.split(F.lower(text), "[;,]"), lambda x: F.trim(x)), lambda x: x != "")

    def kind(part):
        has = lambda marks: reduce(lambda a, b: a | b, [F.contains(part, F.lit(m)) for m in marks])
        return reduce(lambda c, a: c.when(has(a[1]), a[0]), V.APPLICATIONS, F.when(F.lit(False), F.lit("")))

    return F.array_sort(F.array_distinct(F.filter(F.transform(parts, kind), lambda x: x.isNotNull())))


def pair_key(a: Column, b: Column) -> Column:
    return F.array_join(F.array_sort(F.array(a, b)), "+")


def like_pattern(query: str) -> str:
    """Contains-pattern of a caller's text: its * and % become spaces, _ stays a wildcard."""
    return "%" + query.replace("*", " ").replace("%", " ").strip() + "%"


def valid_id(text: Column) -> Column:
    return text.rlike(V.IDENTIFIER)


def object_class(path: Column) -> Column:
    """Class of a stored object by its name; a gzipped file by what is inside."""
    name = F.regexp_replace(path, "^.*/", "")
    inner = F.regexp_replace(F.lower(name), r"\.gz$", "")
    stem, suffix = F.regexp_extract(inner, r"^([^.]*)", 1), F.regexp_extract(inner, r"\.([^.]*)$", 1)
    words = F.split(stem, "[^a-z0-9]+")
    source = F.arrays_overlap(words, F.array(*map(F.lit, V.PUBLISHER_WORDS))) | stem.rlike("^page[-_]?[0-9]+$")
    return F.when((name == V.PLACEHOLDER) | suffix.isin(V.DATA_SUFFIXES), "data").when(~suffix.isin(V.IMAGE_SUFFIXES), "unclassified").when(source, "publisher_derived").when(stem.isin(V.OWN_STEMS), "own_replot").otherwise("unclassified")


def year_in(text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, r"\b((?:19|20)[0-9]{2})\b", 1), F.lit("")).cast("int")


def first_long_line(text: Column, longer: int = 20) -> Column:
    return F.get(F.filter(F.transform(F.split(text, "\n"), lambda x: F.trim(x)), lambda x: F.length(x) > longer), F.lit(0))


def guarded_cell(text: Column) -> Column:
    """A cell that no spreadsheet takes for a formula."""
    return F.when(text.rlike(r"^[=+\-@]"), F.concat(F.lit("'"), text)).otherwise(text)
