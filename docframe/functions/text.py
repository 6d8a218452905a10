"""Text functions, all Column -> Column. White space is Unicode white space, lengths are code points."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

TAG = r"\{\{[A-Z_0-9]+\}\}"
ANY_CASE_TAG = r"(?i)\{\{[A-Z_0-9]+\}\}"
LETTERS = "[a-zA-ZÀ-ÿ]"

#: French stop words of the keyword extractors.
STOP_BASE = "le la les de du des un une et ou à au aux en pour par sur dans avec ce cette ces".split()
STOP_VALIDATOR = [*STOP_BASE, *"est sont qui que dont son sa ses".split()]
STOP_PAGE = [*STOP_BASE, *"est sont qui que dont son sa ses votre".split()]

STOP_FIELD = [*STOP_BASE, *"sans qui que dont où si ne pas plus moins".split()]


def trim_all(c: Column) -> Column:
    return F.regexp_replace(c, r"^(?U)\s+|(?U)\s+$", "")


def collapse(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))  # no other white space is left


def normalize_text(c: Column) -> Column:
    """Private-use and control characters go, hard spaces become spaces, runs of white space one space; trimmed."""
    bare = F.regexp_replace(F.regexp_replace(c, "[-]", ""), "[\\x00-\\x1F]", "")
    return collapse(F.translate(bare, " ", " "))


def has_tag(c: Column) -> Column:
    return c.rlike(TAG)


def contains_letters(c: Column) -> Column:
    return c.rlike(LETTERS)


def strip_braces(c: Column) -> Column:
    return F.translate(c, "{}", "")


def wrap_braces(c: Column) -> Column:
    return F.concat(F.lit("{{"), c, F.lit("}}"))


def truncate(c: Column, limit: int = 100) -> Column:
    return F.when(F.length(c) > limit, F.concat(F.left(c, F.lit(limit)), F.lit("..."))).otherwise(c)


def escape_xml(c: Column, quotes: bool = True) -> Column:
    pairs = [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), *([('"', "&quot;"), ("'", "&apos;")] if quotes else [])]
    return reduce(lambda acc, p: F.replace(acc, F.lit(p[0]), F.lit(p[1])), pairs, c)


def count_words(c: Column) -> Column:
    return F.size(F.filter(F.split(trim_all(c), r"(?U)\s+"), lambda x: x != ""))


def count_characters(c: Column) -> Column:
    """Characters that are not white space."""
    return F.length(F.regexp_replace(c, r"(?U)\s", ""))


def clean_label(c: Column) -> Column:
    return trim_all(F.regexp_replace(c, TAG, ""))


_ACCENTS = ("ÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝ", "AAAAAACEEEEIIIINOOOOOUUUUY")


def sanitize_tag_name(c: Column) -> Column:
    """Upper case without accents, other characters than letters and digits to one underscore, at most 40."""
    plain = F.translate(F.upper(c), *_ACCENTS)
    name = F.left(F.regexp_replace(F.regexp_replace(plain, "[^A-Z0-9]+", "_"), "^_+|_+$", ""), F.lit(40))
    return F.when(name == "", F.lit("CHECKBOX")).otherwise(name)


def fold_label(c: Column) -> Column:
    """Lower case; what is neither a letter, a digit nor white space becomes a space."""
    return collapse(F.regexp_replace(F.lower(c), r"[^a-z0-9\sàâäéèêëïîôùûç]", " "))


def checkbox_label(c: Column) -> Column:
    """As fold_label, but symbols go without leaving a space."""
    return collapse(F.regexp_replace(F.lower(c), r"[^a-z0-9_\sàâäéèêëïîôùûç]", ""))


def keywords(c: Column, stop: list[str] | None = None, least: int = 3) -> Column:
    """Words of at least `least` letters that are no stop words, in order, repeats kept."""
    words = F.split(F.regexp_replace(F.lower(c), "[^a-zà-ÿ]+", " "), " ")
    stops = F.array(*map(F.lit, stop or STOP_BASE))
    return F.filter(words, lambda w: (F.length(w) >= least) & ~F.array_contains(stops, w))


def keyword_similarity(a: Column, b: Column) -> Column:
    """Share of the longer keyword list whose words of a hold or are held by one of b; 0 for an empty list."""
    hits = F.size(F.filter(a, lambda x: F.exists(b, lambda y: F.contains(x, y) | F.contains(y, x))))
    most = F.greatest(F.size(a), F.size(b))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), hits / most).otherwise(F.lit(0.0))


def keyword_score(words: Column, text: Column) -> Column:
    """Summed length of the words that the text contains."""
    lower = F.lower(text)
    return F.aggregate(words, F.lit(0), lambda acc, w: acc + F.when(F.contains(lower, w), F.length(w)).otherwise(0))


def labels_match(a: Column, b: Column, compat: bool = False) -> Column:
    """At least min(2, n, m) common words of three letters; without such words only compat says yes."""
    x, y = (F.filter(F.split(fold_label(c), " "), lambda w: F.length(w) >= 3) for c in (a, b))
    common = F.size(F.filter(x, lambda w: F.array_contains(y, w)))
    empty = (F.size(x) == 0) | (F.size(y) == 0)
    return F.when(empty, F.lit(compat)).otherwise(common >= F.least(F.lit(2), F.size(x), F.size(y)))


def context_matches(label: Column, context: Column) -> Column:
    """Whether min(2, n) of the label's keywords stand in the context; labels without keywords always match."""
    words = keywords(label)
    found = F.size(F.filter(words, lambda w: F.contains(F.lower(context), w)))
    return (F.size(words) == 0) | (found >= F.least(F.lit(2), F.size(words)))


def wrap(c: Column, width: Column | float, per_char: Column | float = 1.0) -> Column:
    """Greedy lines: words are added while the line's estimated width fits; a wider word stands alone."""
    limit = F.lit(width).cast("double") if isinstance(width, int | float) else width
    unit = F.lit(per_char).cast("double") if isinstance(per_char, int | float) else per_char
    words = F.filter(F.split(c, r"(?U)\s+"), lambda w: w != "")

    def add(lines: Column, word: Column) -> Column:
        last = F.element_at(lines, -1)
        joined = F.concat(last, F.lit(" "), word)
        fits = (F.size(lines) > 0) & (F.length(joined) * unit <= limit)
        return F.when(fits, F.concat(F.slice(lines, 1, F.size(lines) - 1), F.array(joined))).otherwise(F.concat(lines, F.array(word)))

    return F.aggregate(words, F.array().cast("array<string>"), add)


def is_oui(label: Column) -> Column:
    return label.rlike("^oui([ .,]|$)")


def is_non(label: Column) -> Column:
    return label.rlike("^non([ .,]|$)")


def checkbox_symbol(value: Column, style: str = "unicode") -> Column:
    on, off = {"unicode": ("☑", "☐"), "text": ("X", " "), "boolean": ("true", "false")}[style]
    return F.when(value, F.lit(on)).when(~value, F.lit(off))


def insertion_point(c: Column) -> Column:
    return F.when(c.isin("after_colon", "replace_empty", "inline", "table_cell", "checkbox"), c).otherwise(F.lit("after_colon"))
