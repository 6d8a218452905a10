"""Units, colours, boxes and text measures."""

from __future__ import annotations

import math
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

MM, INCH, TWIP, EMU = 2.83465, 72, 20, 12700


def mm_to_points(c: Column) -> Column:
    return c * MM


def points_to_mm(c: Column) -> Column:
    return c / MM


def inches_to_points(c: Column) -> Column:
    return c * INCH


def points_to_inches(c: Column) -> Column:
    return c / INCH


def twips_to_points(c: Column) -> Column:
    return c / TWIP


def emu_to_points(c: Column) -> Column:
    return c / EMU


def is_hex_color(c: Column) -> Column:
    return c.rlike("^#?[0-9A-Fa-f]{6}$")


def hex_to_rgb(c: Column) -> Column:
    """Struct(r, g, b) between 0 and 1; null for no colour."""
    bare = F.regexp_replace(c, "^#", "")
    part = lambda i: F.conv(F.substring(bare, i, 2), 16, 10).cast("double") / 255
    return F.when(is_hex_color(c), F.struct(part(1).alias("r"), part(3).alias("g"), part(5).alias("b")))


def scale_to_fit(w: Column, h: Column, max_w: Column, max_h: Column) -> Column:
    """Struct(width, height): shrunk in proportion, never enlarged."""
    ratio = F.least(max_w / w, max_h / h, F.lit(1.0))
    return F.struct((w * ratio).alias("width"), (h * ratio).alias("height"))


def content_area(width: Column, height: Column, top: Column, right: Column, bottom: Column, left: Column) -> Column:
    return F.struct(left.alias("x"), bottom.alias("y"), (width - left - right).alias("width"), (height - top - bottom).alias("height"))


def fits_on_page(y: Column, needed: Column, bottom: Column) -> Column:
    return y - bottom >= needed


def text_width(c: Column, size: Column) -> Column:
    return F.length(c) * 0.5 * size


#: Advance widths of the standard sans-serif font of page documents, in thousandths of its size, by character.
GLYPHS = [
    (" ", 278), ("!", 278), ('"', 355), ("#", 556), ("$", 556), ("%", 889), ("&", 667), ("'", 191), ("(", 333), (")", 333), ("*", 389), ("+", 584), (",", 278), ("-", 333), (".", 278), ("/", 278), ("0123456789", 556),
    (":", 278), (";", 278), ("<", 584), ("=", 584), (">", 584), ("?", 556), ("@", 1015),
    ("AB", 667), ("CD", 722), ("E", 667), ("F", 611), ("G", 778), ("H", 722), ("I", 278), ("J", 500), ("K", 667), ("L", 556), ("M", 833), ("N", 722), ("O", 778), ("P", 667), ("Q", 778), ("R", 722), ("S", 667), ("T", 611), ("U", 722), ("V", 667), ("W", 944), ("XY", 667), ("Z", 611),
    ("[", 278), ("\\", 278), ("]", 278), ("^", 469), ("_", 556), ("`", 333),
    ("ab", 556), ("c", 500), ("de", 556), ("f", 278), ("gh", 556), ("ij", 222), ("k", 500), ("l", 222), ("m", 833), ("nopq", 556), ("r", 333), ("s", 500), ("t", 278), ("u", 556), ("v", 500), ("w", 722), ("xyz", 500),
    ("{", 334), ("|", 260), ("}", 334), ("~", 584), ("\xa0", 278), ("«»", 556), ("°", 400), ("ß", 611), ("Æ", 1000), ("æ", 889), ("ìíîï", 278),
]
#: Width of every other character.
_OTHER = 556


def glyph_table() -> list[int]:
    """Widths by code point up to 255: those of GLYPHS, and for a letter with an accent those of the letter."""
    known = {ch: w for chars, w in GLYPHS for ch in chars}
    base = lambda ch: unicodedata.normalize("NFD", ch)[0]
    return [known.get(chr(i), known.get(base(chr(i)), _OTHER)) for i in range(256)]


def glyph_width(c: Column, size: Column | float = 1.0) -> Column:
    """Width of a text in the standard font at a size, its glyphs' widths summed; kerning of pairs is left out."""
    table = F.array(*map(F.lit, glyph_table()))
    unit = F.lit(float(size)) if isinstance(size, int | float) else size
    total = F.aggregate(F.split(c, ""), F.lit(0), lambda acc, ch: acc + F.when(ch == "", 0).otherwise(F.coalesce(F.get(table, F.ascii(ch)), F.lit(_OTHER))))
    return total * unit / 1000


def wrap_measured(c: Column, width: Column | float, size: Column | float) -> Column:
    """Greedy lines of a text in the standard font: words are added while the line's width fits, a wider word stands alone. Each word is
    measured once, and a line's width is carried along."""
    limit, unit = (F.lit(float(x)) if isinstance(x, int | float) else x for x in (width, size))
    words = F.transform(F.filter(F.split(c, r"(?U)\s+"), lambda w: w != ""), lambda w: F.struct(w.alias("t"), glyph_width(w).alias("w")))
    space = dict((ch, w) for chars, w in GLYPHS for ch in chars)[" "] / 1000
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("line"), F.lit(0.0).alias("at"))

    def add(s: Column, word: Column) -> Column:
        longer = s["at"] + space + word["w"]
        first, fits = s["line"] == "", longer * unit <= limit
        return F.struct(
            F.when(first | fits, s["done"]).otherwise(F.concat(s["done"], F.array(s["line"]))).alias("done"),
            F.when(first, word["t"]).when(fits, F.concat(s["line"], F.lit(" "), word["t"])).otherwise(word["t"]).alias("line"),
            F.when(first, word["w"]).when(fits, longer).otherwise(word["w"]).alias("at"),
        )

    return F.aggregate(words, start, add, lambda s: F.when(s["line"] == "", s["done"]).otherwise(F.concat(s["done"], F.array(s["line"]))))


def fitting_size_measured(c: Column, width: Column | float, preferred: float, least: float = 6.0) -> Column:
    """The first size from the preferred one down, by halves, at which the text fits the width; the least where none above it does."""
    limit = F.lit(float(width)) if isinstance(width, int | float) else width
    sizes = F.array(*[F.lit(preferred - 0.5 * i) for i in range(max(0, math.ceil(2 * (preferred - least))))]) if preferred > least else F.array().cast("array<double>")
    unit = glyph_width(c)
    return F.coalesce(F.get(F.filter(sizes, lambda s: unit * s <= limit), F.lit(0)), F.lit(float(least)))


def block_height(lines: Column, size: Column, step: float = 1.2) -> Column:
    return lines * size * step


def distance(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.sqrt((x1 - x2) * (x1 - x2) + (y1 - y2) * (y1 - y2))


def position_similarity(d: Column, tolerance: float) -> Column:
    """1 within half the tolerance, 0 beyond twice of it, falling in between."""
    return F.when(d < tolerance / 2, 1.0).when(d > 2 * tolerance, 0.0).otherwise(1 - d / (2 * tolerance))


def relative_score(d: Column) -> Column:
    return F.greatest(F.lit(0.0), 1 - 5 * d)


def fitting_font_size(c: Column, width: Column, largest: float = 9.0, least: float = 6.0) -> Column:
    """The largest size, in steps of a half, whose estimated width fits; else the least."""
    sizes = F.sequence(F.lit(int(2 * least)), F.lit(int(2 * largest)))
    fits = F.filter(sizes, lambda s: text_width(c, s / 2) <= width)
    return F.coalesce(F.array_max(fits) / 2, F.lit(least))


def field_type(label: Column) -> Column:
    t = F.lower(label)
    has = lambda *words: t.rlike("|".join(words))
    return (
        F.when(has("date", "le ", "du "), "date")
        .when(has("oui", "non", "cochez"), "checkbox")
        .when(has("montant", "prix", "€", "nombre", "n°", "siret"), "number")
        .when(has("adresse", "description", "observations"), "multiline")
        .otherwise("text")
    )


def placement_type(text: Column) -> Column:
    t = F.rtrim(text)
    return F.when(t.endswith(":"), "after_colon").when(t == "", "replace").otherwise("inline")


def image_type(content: Column) -> Column:
    """MIME type by the first bytes; null for others."""
    h = F.hex(F.substring(content, 1, 4))
    return F.when(h == "89504E47", "image/png").when(h.startswith("FFD8FF"), "image/jpeg").when(h.startswith("474946"), "image/gif").when(h.startswith("424D"), "image/bmp")


def option_errors(font: Column, *margins: Column) -> Column:
    """Messages of values out of range: font size 6 to 72, margins 0 to 200."""
    bad = [F.when(~font.between(6, 72), F.lit("font size must be between 6 and 72"))]
    bad += [F.when(~m.between(0, 200), F.lit("margins must be between 0 and 200")) for m in margins]
    return F.array_compact(F.array(*bad))


def table_format_errors(c: Column) -> Column:
    """A message where the format of tables is given and is neither array nor objects."""
    return F.array_compact(F.array(F.when(~c.isin("", "array", "objects"), F.lit("table format must be array or objects"))))
