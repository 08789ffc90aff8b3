"""Column functions over legal texts: normal forms, HTML, truncation, dates and codes."""

from __future__ import annotations

import unicodedata
import zlib
from functools import reduce
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F


def _bases() -> tuple[str, str]:
    """Latin letters with marks, and the letters without them."""
    marked, plain = [], []
    for code in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        base = [c for c in unicodedata.normalize("NFD", chr(code)) if unicodedata.category(c) != "Mn"]
        if len(base) == 1 and base[0] != chr(code):
            marked.append(chr(code))
            plain.append(base[0])
    return "".join(marked), "".join(plain)


MARKED, PLAIN = _bases()

#: The folder name of a case, and the accents that a Portuguese text must have one of.
CASE_ID = r"\d{7}-\d{2}\.\d{4}\.\d\.\d{2}\.\d{4}"
ACCENT = "[áéíóúâêôãõàçÁÉÍÓÚÂÊÔÃÕÀÇ]"

#: White space as Python's str.strip and \s know it.
SPACE = r"[\s\x1c-\x1f\x85\p{Z}]"


def norm(c: Column) -> Column:
    """Lower case without accents; ß becomes ss. Null stays null."""
    bare = F.regexp_replace(F.translate(c, MARKED, PLAIN), r"\p{Mn}+", "")
    return F.replace(F.lower(bare), F.lit("ß"), F.lit("ss"))


def norm_ws(c: Column) -> Column:
    """norm, with runs of white space as one space and none at the ends."""
    return F.trim(F.regexp_replace(norm(c), SPACE + "+", " "))


def stripped(c: Column) -> Column:
    return F.regexp_replace(c, f"^{SPACE}+|{SPACE}+$", "")


def blank(c: Column) -> Column:
    """Null or white space alone."""
    return F.coalesce(stripped(c) == "", F.lit(True))


def case_id(path: Column) -> Column:
    """The case number in a folder's name, else the name."""
    name = F.regexp_extract(path, r"([^/]+)/*$", 1)
    return F.coalesce(F.nullif(F.regexp_extract(name, CASE_ID, 0), F.lit("")), F.nullif(name, F.lit("")))


#: Tags that separate words.
SPACING_TAGS = ("mark", "p", "br", "strong", "em", "b", "i")


def html_spaced(c: Column) -> Column:
    """Without tags: those that separate words become a space, others nothing; then white space collapses."""
    spaced = F.regexp_replace(c, rf"</?(?:{'|'.join(SPACING_TAGS)})(?:\s[^>]*)?\s*/?>", " ")
    return collapsed(F.regexp_replace(spaced, "<[^>]+>", ""))


def collapsed(c: Column) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(c, SPACE + "+", " "))


def html_bare(c: Column) -> Column:
    """Without tags."""
    return collapsed(F.regexp_replace(c, "<[^>]+>", ""))


def html_words(c: Column) -> Column:
    """Every tag becomes a space."""
    return collapsed(F.regexp_replace(c, "<[^>]+>", " "))


#: What may be an entity: a decimal or hexadecimal number, or a name that a semicolon may end.
ENTITY = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
#: The same with its semicolon.
ENDED_ENTITY = ENTITY.replace(";?", ";")
#: Names that need no semicolon, the longest first, so that a name matches as far as it can.
BARE_NAMES = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
#: Names are looked up in one of so many small maps, by the name's CRC-32.
NAME_MAPS = 256
LAST_CODE = 0x10FFFF


def sql_map(pairs: dict[str, str]) -> str:
    """SQL for a map of constants, spelled in escapes alone."""
    spelled = lambda x: "'" + "".join(f"\\U{ord(ch):08X}" for ch in x) + "'"
    return f"map({', '.join(f'{spelled(k)}, {spelled(v)}' for k, v in pairs.items())})" if pairs else "cast(map() as map<string, string>)"


def named_entities() -> Column:
    maps: list[dict[str, str]] = [{} for _ in range(NAME_MAPS)]
    for name, value in html5.items():
        maps[zlib.crc32(name.encode()) % NAME_MAPS][name] = value
    return F.expr(f"array({', '.join(map(sql_map, maps))})")


def numbered_entity(code: Column) -> Column:
    """The character of a number as browsers read it: 128 to 159 as in Windows-1252, none for control codes and non-characters, U+FFFD for what is no character at all."""
    windows = {i: bytes([i]).decode("cp1252", "ignore") or chr(i) for i in range(0x80, 0xA0)}
    kept = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    nothing = code.between(1, 8) | (code == 0xB) | code.between(0xE, 0x1F) | (code == 0x7F) | code.between(0xFDD0, 0xFDEF) | (code.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE)
    western = F.get(F.lit(list(windows.values())), (code - 0x80).cast("int"))
    return F.when((code == 0) | code.between(0xD800, 0xDFFF) | (code > LAST_CODE), "�").when(code.between(0x80, 0x9F), western).when(nothing, "").otherwise(kept)


def unescaped(c: Column, ended: bool = False) -> Column:
    """HTML 5 entities become characters, each once: "&amp;lt;" becomes "&lt;".

    As browsers and Python's html.unescape do it: some names need no semicolon
    and match as a prefix ("&copy2" becomes "©2"); unknown names stay.  ended:
    only entities with their semicolon, so that "&copy2" stays."""
    names = named_entities()

    def one(x: Column) -> Column:
        body = F.substring(x, 2, 1 << 30)
        digits = F.regexp_extract(body, "^#0*([0-9]+);?$", 1)
        hexed = F.regexp_extract(body, "^#[xX]0*([0-9a-fA-F]+);?$", 1)
        # longer numbers are beyond the last code
        code = F.when(digits != "", F.when(F.length(digits) > 9, F.lit(LAST_CODE + 1).cast("long")).otherwise(digits.try_cast("long"))).otherwise(F.when(F.length(hexed) > 8, F.lit(LAST_CODE + 1).cast("long")).otherwise(F.conv(hexed, 16, 10).try_cast("long")))
        known = lambda name: F.element_at(F.get(names, (F.crc32(F.encode(name, "UTF-8")) % NAME_MAPS).cast("int")), name)
        start = F.regexp_extract(body, f"^(?:{'|'.join(BARE_NAMES)})", 0)
        prefix = F.when(start != "", F.concat(known(start), F.substring(body, F.length(start) + 1, F.length(body))))
        return F.when(F.startswith(body, F.lit("#")), numbered_entity(code)).otherwise(F.coalesce(known(body), x if ended else prefix, x))

    parts = F.regexp_extract_all(c, F.lit(f"{ENDED_ENTITY if ended else ENTITY}|&|[^&]+"), F.lit(0))
    return F.when(~F.contains(c, F.lit("&")), c).otherwise(F.array_join(F.transform(parts, lambda x: F.when(F.startswith(x, F.lit("&")) & (F.length(x) > 1), one(x)).otherwise(x)), ""))


#: What the electoral portal's texts have unescaped, in this order; the ampersand comes last.
PORTAL = {"&nbsp;": " ", "&ndash;": "–", "&mdash;": "—", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#34;": "'", "&#39;": "'"}


def html_portal(c: Column) -> Column:
    """Without tags; the portal's few entities and decimal numbers unescaped, then the ampersand, so that "&amp;#65;" becomes "&#65;"; runs of white space collapse."""
    out = reduce(lambda x, e: F.replace(x, F.lit(e[0]), F.lit(e[1])), PORTAL.items(), F.regexp_replace(c, "<[^>]+>", ""))
    parts = F.regexp_extract_all(out, F.lit("(?s)&#[0-9]{1,7};|&|[^&]+"), F.lit(0))
    decimal = F.array_join(F.transform(parts, lambda x: F.when(x.rlike("^&#[0-9]"), unescaped(x)).otherwise(x)), "")
    return F.trim(F.regexp_replace(F.replace(decimal, F.lit("&amp;"), F.lit("&")), r"\s{2,}", " "))


def html_text(c: Column, ended: bool = False) -> Column:
    """Readable text: scripts and styles become a space, breaks and the ends of blocks line ends; entities unescaped (ended: those with a semicolon alone), blank lines collapsed."""
    out = F.regexp_replace(c, r"(?s)<(script|style).*?</\1>", " ")
    out = F.regexp_replace(F.regexp_replace(out, r"<br\s*/?>", "\n"), r"</(?:p|div|tr|li|h\d)>", "\n")
    out = unescaped(F.regexp_replace(out, "<[^>]+>", " "), ended)
    return stripped(F.regexp_replace(F.regexp_replace(out, r"[ \t]+", " "), rf"\n{SPACE}*\n+", "\n\n"))


def truncated(c: Column, most: int) -> Column:
    """At most `most` characters, cut back to the last full stop if that is beyond four fifths of them, and marked."""
    cut = F.substring(c, 1, most)
    at = F.length(cut) - F.instr(F.reverse(cut), ".")  # place of the last full stop, from 0
    ends = (F.instr(cut, ".") > 0) & (at > 0.8 * most)
    return F.when(F.length(c) <= most, c).otherwise(F.concat(F.when(ends, F.substring(cut, F.lit(1), at + 1)).otherwise(cut), F.lit(" [...]")))


def xml_escaped(c: Column) -> Column:
    """The ampersand first."""
    return reduce(lambda out, e: F.replace(out, F.lit(e[0]), F.lit(e[1])), (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")), c)


#: The time of an ISO date-time, as far as it is given, with its zone.
ISO_TIME = r"(?:[01]\d|2[0-3])(?::?[0-5]\d(?::?[0-5]\d(?:[.,]\d+)?)?)?(?:Z|[+-](?:[01]\d|2[0-3])(?::?[0-5]\d)?)?"


def brazilian_date(c: Column) -> Column:
    """ISO date-times and YYYYMMDD as DD/MM/YYYY; anything else, dates that don't exist too, unchanged. Eight digits aren't checked."""
    day = F.substring(c, 1, 10)
    is_time = c.rlike(rf"^\d{{4}}-\d{{2}}-\d{{2}}T{ISO_TIME}$") & F.try_to_date(day, "yyyy-MM-dd").isNotNull()
    iso = F.concat_ws("/", F.substring(c, 9, 2), F.substring(c, 6, 2), F.substring(c, 1, 4))
    packed = F.concat_ws("/", F.substring(c, 7, 2), F.substring(c, 5, 2), F.substring(c, 1, 4))
    return F.when(is_time, iso).when(c.rlike(r"^\d{8}$"), packed).otherwise(c)


def court_code(c: Column) -> Column:
    """TRF5 becomes TRF05: regional courts have two digits."""
    return F.regexp_replace(F.upper(F.trim(c)), r"^(TRF|TRT)(\d)$", "$10$2")


def slug(c: Column) -> Column:
    """A file name: without accents, words joined by hyphens."""
    return F.regexp_replace(F.regexp_replace(norm(c), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def cdata(c: Column) -> Column:
    """All CDATA blocks of an escaped answer, joined."""
    return F.array_join(F.regexp_extract_all(unescaped(c), F.lit(r"(?s)<!\[CDATA\[(.*?)\]\]>"), F.lit(1)), "")


def lines(c: Column) -> Column:
    """The lines of a text, as Python's splitlines cuts them: at line feeds, carriage returns, vertical tabs, form feeds, separators and next-line marks; a line end at the end begins no line."""
    cut = F.split(F.regexp_replace(c, "\r\n", "\n"), "[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]", -1)
    return F.when(F.get(cut, F.size(cut) - 1) == "", F.slice(cut, F.lit(1), F.size(cut) - 1)).otherwise(cut)


def url_encoded(c: Column, charset: str = "UTF-8") -> Column:
    """Form encoding of a value in UTF-8, or in ISO-8859-1 for portals that ask for it, with a question mark for what that lacks."""
    if charset == "UTF-8":
        return F.url_encode(c)
    hexed = F.hex(F.encode(F.regexp_replace(c, r"[^\x00-\xFF]", "?"), charset))
    bytes_ = F.regexp_extract_all(hexed, F.lit(".."), F.lit(0))
    plain = lambda h: F.decode(F.unhex(h), "ISO-8859-1")
    one = lambda h: F.when(plain(h).rlike("[A-Za-z0-9.*_-]"), plain(h)).when(h == "20", "+").otherwise(F.concat(F.lit("%"), h))
    return F.array_join(F.transform(bytes_, one), "")


def padded(c: Column, width: int) -> Column:
    """Zero padding to a least width; longer numbers stay whole."""
    text = c.cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def clamped(c: Column, low: int, high: int) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), c))


def text_window(c: Column, begin: int, size: int) -> Column:
    """Characters from `begin` (0-based), and where to go on: null at the end. The size is kept to 1,000 to 100,000."""
    size = max(1000, min(size, 100_000))
    more = F.when(F.length(c) > begin + size, F.lit(begin + size))
    return F.struct(F.substring(c, begin + 1, size).alias("text"), more.alias("next"))


def digits(c: Column, width: int | None = None) -> Column:
    """The digits alone, as of a taxpayer's number; null if there are none, or not `width` of them."""
    found = F.nullif(F.regexp_replace(c, "[^0-9]", ""), F.lit(""))
    return found if width is None else F.when(F.length(found) == width, found)


def id_and_type(c: Column) -> Column:
    """struct(id, type) of "<digits> - <type> (note)": the last parenthesis is dropped."""
    return F.struct(F.nullif(F.regexp_extract(c, r"^\s*(\d+)\s*-", 1), F.lit("")).alias("id"), stripped(F.regexp_replace(F.regexp_replace(c, r"^\s*\d+\s*-\s*", ""), r"\s*\([^()]*\)\s*$", "")).alias("type"))


def month_label(day: Column) -> Column:
    return F.date_format(day, "MM/yyyy")


def pages_for(n: Column, size: int) -> Column:
    """How many pages of a size hold n rows."""
    return F.ceil(n / size).cast("long")


def page_bucket(n: Column, sizes: tuple[int, ...] = (25, 50, 100)) -> Column:
    """The smallest page size that holds n rows, or the largest there is."""
    out = F.lit(sizes[-1])
    for size in sizes[-2::-1]:
        out = F.when(n <= size, size).otherwise(out)
    return out
