"""Column expressions on texts and file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .helpers import ascii_fold, compound_kind, entities_decoded

#: Fixed values.
SSN = r"\b\d{3}-\d{2}-\d{4}\b"
PORTFOLIO = r"open this PDF portfolio"
STAMPS = [
    r"^\s*FILED:\s*[A-Z][A-Z .'-]*?COUNTY CLERK\b.*$",
    r"^\s*FILED:\s*APPELLATE DIVISION\b.*$",
    r"^\s*NYSCEF DOC\.?\s*NO\.?\s*\d+.*$",
    r"^\s*RECEIVED NYSCEF:.*$",
    r"^\s*INDEX NO\.?\s*[\w/.-]+\s*$",
    r"^\s*Case\s+\d+:\d+-[a-z]{2}-\d+.*?Filed\s+\d{2}/\d{2}/\d{2,4}.*$",
    r"^\s*(?:Page\s+)?\d+\s+of\s+\d+\s*$",
]
OWN_CHARS_PER_PAGE, LETTERS, LONG_WORDS, LEAST_TO_JUDGE = 100, 0.45, 0.25, 60
CODE_SIGNALS = (
    r"\bfunction\b|=>|\bvar\s|\bconst\s|\blet\s|\bthis\.|\bwindow\.|\bdocument\.|"
    r"\$\(|\bprototype\b|\bmodule\.exports\b|\brequire\(|\bundefined\b|===|!==|"
    r"\buse\s+strict\b|\bmy\s+[$@%]\w|\bsub\s+\w+\s*\{|!important|@media\b|"
    r"[.#]?[\w-]+\s*\{[^{}]{0,200}:[^{}]{0,200};"
)
PASSWORD_FILE = r"password|passcode|\bpass\b|\bpwd\b|clave|contrase"
LABELLED_PASSWORD = r"(?:passwords?|passcodes?|pass|pwd|clave|contrase\w*)\s*(?:is|es|:|=)+\s*[\"'“]?([^\s\"'”]{4,60})"
#: Extensions that say nothing.
MEANINGLESS = ["", "download", "crdownload", "part", "dat", "tmp", "bin", "file", "unknown"]
TEXT_LIKE = ["txt", "html", "xml"]
EXTENSION_LIKE = r"\A[a-z][a-z0-9]{0,5}\z"
SPACES = r"\s\x{85}\x{a0}\x{1c}-\x{1f}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def py_regex(pattern: str, ignore_case: bool = True) -> str:
    """A pattern with the meaning that it has in Python: line anchors know only the line feed."""
    return ("(?imd)" if ignore_case else "(?md)") + pattern


def blank(text: Column) -> Column:
    """Null, empty or white space only, with all of Unicode's white space."""
    return F.coalesce(~text.rlike(f"[^{SPACES}]"), F.lit(True))


def strip_spaces(text: Column) -> Column:
    return F.regexp_replace(text, f"^[{SPACES}]+|[{SPACES}]+$", "")


def extension_of(name: Column) -> Column:
    return F.when(name.contains("."), F.lower(F.substring_index(name, ".", -1))).otherwise("")


def normalize_folder_name(name: Column) -> Column:
    """Lower-case words without accents, punctuation and numeric prefix."""
    plain = F.regexp_replace(ascii_fold(F.coalesce(name, F.lit(""))), r"^\d+[_\-. ]+", "")
    return F.trim(F.regexp_replace(F.lower(plain), "[^a-z0-9]+", " "))


def normalize_name(text: Column) -> Column:
    plain = F.regexp_replace(F.lower(ascii_fold(F.coalesce(text, F.lit("")))), "[^a-z0-9 ]+", " ")
    return F.trim(F.regexp_replace(plain, r"\s+", " "))


def contains_ssn(text: Column) -> Column:
    return F.coalesce(text.rlike(SSN), F.lit(False))


def mask_ssn(text: Column) -> Column:
    return F.regexp_replace(text, r"\b\d{3}-\d{2}-(\d{4})\b", "XXX-XX-$1")


def strip_efiling_stamps(text: Column) -> Column:
    """Without court stamps: to measure a text, never to return it."""
    for s in STAMPS:
        text = F.regexp_replace(text, py_regex(s), "")
    return text


def letter_ratio(text: Column) -> Column:
    letters = F.length(F.regexp_replace(text, r"[^\p{L}]+", ""))
    solid = F.length(F.regexp_replace(text, f"[{SPACES}]+", ""))
    return letters / F.greatest(solid, F.lit(1))


def long_word_ratio(text: Column) -> Column:
    words = F.regexp_extract_all(text, F.lit("[A-Za-z]{2,}"), F.lit(0))
    long = F.size(F.filter(words, lambda w: F.length(w) >= 4))
    return F.when(F.size(words) == 0, 0.0).otherwise(long / F.greatest(F.size(words), F.lit(1)))


def needs_ocr(text: Column, pages: Column) -> Column:
    """Struct of flag and reason: whether a text layer is no use and why."""
    own = strip_efiling_stamps(text)
    n, stamp = F.length(own), F.length(text) - F.length(own)
    few = F.concat(
        F.lit("only "), n, F.lit(" characters of its own in "), pages, F.lit(" page(s)"),
        F.when(stamp > 0, F.concat(F.lit(" ("), stamp, F.lit(" more were the e-filing stamp)"))).otherwise(""),
        F.lit(": the page is an image and the text is just a stamp"),
    )
    glyphs = "embedded fonts with no character map: the text layer gives glyph indexes, not letters"
    reason = (
        F.when(blank(text), "the text layer came back empty")
        .when(text.rlike(py_regex(PORTFOLIO)), "it is a PDF portfolio: the content is in the attachments")
        .when(n / F.greatest(pages, F.lit(1)) < OWN_CHARS_PER_PAGE, few)
        .when((letter_ratio(own) < LETTERS) & (long_word_ratio(own) < LONG_WORDS), glyphs)
        .otherwise("")
    )
    return F.struct((reason != "").alias("flag"), reason.alias("reason"))


def looks_like_noise(text: Column) -> Column:
    """Whether what a reader made of an image is only stains."""
    clean = strip_spaces(text)
    n, long = F.size(F.regexp_extract_all(clean, F.lit("[A-Za-z]{2,}"), F.lit(0))), long_word_ratio(clean)
    judged = F.when(n == 0, True).when(n < 5, long == 0).otherwise(long < LONG_WORDS)
    return F.when(F.length(clean) < LEAST_TO_JUDGE, False).otherwise(judged)


def looks_like_code(text: Column) -> Column:
    """Web code rather than a document, judged on its first 40,000 bytes."""
    head = F.when(F.octet_length(text) <= 40_000, text).otherwise(F.regexp_replace(F.make_valid_utf8(F.substring(text.cast("binary"), 1, 40_000).cast("string")), "�$", ""))
    signals = F.size(F.regexp_extract_all(head, F.lit(CODE_SIGNALS), F.lit(0)))
    density = F.length(F.regexp_replace(head, "[^{};()=]+", "")) / F.greatest(F.length(head), F.lit(1))
    return F.when(blank(text), False).otherwise(((signals >= 5) & (density > 0.03)) | (signals >= 30))


def decode_text(content: Column) -> Column:
    """Struct of text and failure: the text of bytes in the first of UTF-8, UTF-16, Windows-1252 and Latin-1 that fits.

    UTF-16 without a byte order mark is little-endian; it fits if the bytes are pairs and no surrogate stands alone."""
    data = F.coalesce(content, F.lit(b""))
    latin = F.decode(data, "ISO-8859-1")
    big = F.hex(F.substring(data, 1, 2)) == "FEFF"
    marked = big | (F.hex(F.substring(data, 1, 2)) == "FFFE")
    body = F.when(marked, F.substring(data, 3, 2**31 - 1)).otherwise(data)
    # one unit of two bytes a word, the high byte first
    units = F.regexp_replace(F.hex(body), "(..)(..)", F.when(big, F.lit("$1$2 ")).otherwise("$2$1 "))
    alone = units.rlike("D[89AB].. (?!D[C-F])|(?<!D[89AB].. )D[C-F].. ")
    pairs = (F.octet_length(data) % 2 == 0) & ~alone
    wide = F.when(big, F.decode(body, "UTF-16BE")).otherwise(F.decode(body, "UTF-16LE"))
    moved = {bytes([b]).decode("latin-1"): bytes([b]).decode("cp1252", "ignore") for b in range(0x80, 0xA0)}
    known = {k: v for k, v in moved.items() if v}
    windows = F.translate(latin, "".join(known), "".join(known.values()))
    unknown = "".join(k for k, v in moved.items() if not v)
    text = (
        F.when(F.is_valid_utf8(data.cast("string")), data.cast("string"))
        .when(pairs, wide)
        .when(~latin.rlike(f"[{unknown}]"), windows)
        .otherwise(latin)
    )
    none = blank(text)
    return F.struct(F.when(none, "").otherwise(text).alias("text"), F.when(none, "the text file is empty").otherwise("").alias("failure"))


#: Tags whose end breaks the line.
BLOCK_TAGS = ["p", "div", "br", "tr", "li", "h1", "h2", "h3", "td", "th"]


def html_to_text(html: Column) -> Column:
    """What a page shows: no scripts, styles, comments and tags; pieces between tags stripped and joined by spaces, a line
    end for each closing block tag or cell, references decoded, never more than two line ends in a row."""
    shown = F.regexp_replace(html, r"(?is)<!--.*?(?:-->|$)|<(script|style)\b[^>]*>.*?(?:</\1\s*>|$)", "\u0002")
    shown = F.regexp_replace(shown, rf"(?i)</(?:{'|'.join(BLOCK_TAGS)})\s*>", "\u0002\u0001\u0002")
    shown = F.regexp_replace(shown, r"""<[a-zA-Z/!?][^<>"']*+(?:(?:"[^"]*"|'[^']*')[^<>"']*+)*+>""", "\u0002")
    pieces = F.split(entities_decoded(F.coalesce(shown, F.lit(""))), "\u0002+")
    pieces = F.transform(pieces, lambda p: F.when(p == "\u0001", "\n").otherwise(strip_spaces(p)))
    return F.regexp_replace(F.array_join(F.filter(pieces, lambda p: p != ""), " "), "\n{3,}", "\n\n")


def read_html(html: Column) -> Column:
    """Struct of a page's text and why there is none: nothing was decoded, or the page shows nothing."""
    shown = html_to_text(html)
    failure = F.when(F.coalesce(html, F.lit("")) == "", "could not decode the HTML file").when(blank(shown), "the HTML page has no text").otherwise("")
    return F.struct(F.when(failure == "", shown).otherwise("").alias("text"), failure.alias("failure"))


#: What a container's member, or the type that it begins with, tells.
MEMBERS = {"docx": "word/document.xml", "xlsb": "xl/workbook.bin", "xlsx": "xl/workbook.xml", "pptx": "ppt/presentation.xml"}
STORED_TYPES = {"odt": "opendocument.text", "ods": "opendocument.spreadsheet"}


COMPOUND = "D0CF11E0A1B11AE1"


def container_kind(content: Column) -> Column:
    """What a zip container holds, by the names in its central directory; `zip` if it tells nothing or is cut off.

    A directory entry is a signature, 24 bytes, the name's length, 16 bytes and the name. An open document begins with
    a member `mimetype` that is stored as it is."""
    raw = F.decode(content, "ISO-8859-1")
    entry = lambda n: rf"PK\x01\x02[\s\S]{{24}}\x{len(n):02x}\x00[\s\S]{{16}}" + n.replace(".", r"\.")
    begins = lambda kind: r"\APK\x03\x04[\s\S]{22}\x08\x00[\s\S]{2}mimetype[^P]{0,100}" + kind.replace(".", r"\.")
    found = [(k, entry(n)) for k, n in MEMBERS.items()] + [(k, begins(n)) for k, n in STORED_TYPES.items()]
    return F.coalesce(*[F.when(raw.rlike(pattern), F.lit(k)) for k, pattern in found], F.lit("zip"))


def magic_kind(content: Column, look_inside: bool = True) -> Column:
    """Kind of bytes by their first bytes, null if unknown."""
    head = F.hex(F.substring(content, 1, 16))
    start = lambda *hexes: F.lit(False) if not hexes else _any([head.startswith(h) for h in hexes])
    text = F.decode(F.substring(content, 1, 4000), "ISO-8859-1")
    body = F.regexp_replace(text, "^[\xef\xbb\xbf \t\r\n]+", "")
    low = F.lower(F.substring(body, 1, 1500))
    mail = low.rlike(r"\A(?:(?:received|return-path|from|to|subject|date|mime-version|message-id|x-[\w-]+|content-type):[^\n]*\r?\n)+")
    shown = F.length(F.regexp_replace(text, r"[^\t\r\n\x20-\xff]+", "")) / F.greatest(F.length(text), F.lit(1))
    return (
        F.when(F.length(content) < 4, None)
        .when(F.instr(F.decode(F.substring(content, 1, 1024), "ISO-8859-1"), "%PDF-") > 0, "pdf")
        .when(start(COMPOUND), compound_kind(F.when(start(COMPOUND), content)) if look_inside else F.lit("ole"))
        .when(start("504B0304"), container_kind(content) if look_inside else F.lit("zip"))
        .when(start("377ABCAF271C"), "7z")
        .when(start("789F3E22"), "tnef")
        .when(start("89504E47"), "png")
        .when(start("FFD8FF"), "jpg")
        .when(start("474946383761", "474946383961"), "gif")
        .when(start("49492A00", "4D4D002A"), "tif")
        .when(start("424D") & (F.length(content) > 26), "bmp")
        .when(start("52494646") & (F.substring(head, 17, 8) == "57454250"), "webp")
        .when((F.substring(head, 9, 8) == "66747970") & F.substring(head, 17, 8).isin("68656963", "68656978", "68657663", "6865696D", "68656973", "6D696631", "6D736631"), "heic")
        .when(body.startswith("{\\rtf"), "rtf")
        .when(mail & (low.contains("mime-version:") | low.contains("received:") | low.contains("subject:")), "eml")
        .when(low.startswith("<!doctype html") | low.startswith("<html") | F.substring(low, 1, 600).contains("<html"), "html")
        .when(low.startswith("<?xml"), "xml")
        .when((F.instr(text, "\x00") == 0) & (shown > 0.97), "txt")
    )


def _any(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out | c
    return out


def sniff_content(content: Column, extension: Column, look_inside: bool = True) -> Column:
    """The real extension by content. Text-like answers don't count where the given extension says something: it is
    no placeholder, and short as extensions are, not the rest of a name with a full stop in it."""
    kind = magic_kind(content, look_inside)
    apple_double = F.hex(F.substring(content, 1, 4)) == "00051607"
    given = F.lower(F.coalesce(extension, F.lit("")))
    says_something = ~given.isin(MEANINGLESS) & given.rlike(EXTENSION_LIKE)
    return F.when(apple_double, "appledouble").when(kind.isin(TEXT_LIKE) & says_something, extension).otherwise(kind)


def password_candidates(text: Column) -> Column:
    """Labelled passwords of a text in order, or its single short line."""
    found = F.regexp_extract_all(text, F.lit("(?i)" + LABELLED_PASSWORD), F.lit(1))
    found = F.transform(found, lambda v: F.regexp_replace(v, "^[.,;:]+|[.,;:]+$", ""))
    found = F.array_distinct(F.filter(found, lambda v: (v != "") & ~F.lower(v).isin("is", "es", "the")))
    lines = F.filter(F.transform(F.split(text, r"\r\n|[\n\r\x0b\f\x1c-\x1e\x{85}\x{2028}\x{2029}]"), strip_spaces), lambda x: x != "")
    only = F.when((F.size(lines) == 1) & F.length(F.get(lines, F.lit(0))).between(4, 60), lines).otherwise(F.array().cast("array<string>"))
    return F.when(text.isNull(), F.array().cast("array<string>")).when(F.size(found) > 0, found).otherwise(only)


def is_password_file(name: Column) -> Column:
    return F.coalesce(name.rlike("(?i)" + PASSWORD_FILE), F.lit(False))


def password_in_name(name: Column) -> Column:
    """Labelled password in a file name, without its extension; null if none."""
    stem = F.when(name.contains("."), F.regexp_replace(name, r"\.[^.]*$", "")).otherwise(name)
    found = F.regexp_extract(stem, "(?i)" + LABELLED_PASSWORD, 1)
    return F.when(found != "", F.regexp_replace(found, "^[.,;:]+|[.,;:]+$", ""))


def json_line(row: Column) -> Column:
    """One JSON line: non-ASCII kept, line separators of Unicode escaped, lone surrogates replaced."""
    text = F.to_json(row, {"ignoreNullFields": "false"})
    for char, escape in ((" ", "\\u2028"), (" ", "\\u2029"), ("\x85", "\\u0085")):
        text = F.replace(text, F.lit(char), F.lit(escape))
    return F.regexp_replace(text, "[\\x{d800}-\\x{dfff}]", "?")
