"""Text normalisation, literal containment and page text, as Column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Unicode white space spelled out, one by one where it is Latin-1: Java's \s is ASCII only,
# and single characters of that block match by table look-up.
WS_CLASS = (
    r" \t\n\x0b\f\r\x1c\x1d\x1e\x1f\x{85}\x{a0}"
    r"\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)

# Whole elements that hold no running text; each closes with its own name, scripts and styles first.
_CHROME = ("script", "style", "nav", "footer", "header", "aside")
_COMMENT = r"(?s)<!--.*?-->"
_TAG = r"(?s)<[^>]*>"

# Character references: decimal, hexadecimal, and the names of the standard library's table.
_REFERENCE = r"&(?:#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,30});"
_PLAIN = {"nbsp": " ", "apos": "'"}


def squash_ws(c: Column) -> Column:
    """Remove every white-space character, including U+3000 and NBSP."""
    return F.regexp_replace(c, f"[{WS_CLASS}]+", "")


def collapse_ws(c: Column) -> Column:
    """Collapse runs of white space to one space and trim."""
    return F.trim(F.regexp_replace(c, f"[{WS_CLASS}]+", " "))


def text_norm(c: Column) -> Column:
    """Normal form for containment: no white space, no commas, half-width percent."""
    return F.replace(F.regexp_replace(c, f"[{WS_CLASS},，]+", ""), F.lit("％"), F.lit("%"))


def counted_parts(df: DataFrame, keep: Sequence[str], parts: Column, name: str) -> DataFrame:
    """One row for each distinct element of a row's array, with `n`, how often it is there: no shuffle, no hash table."""
    row = df.select(*keep, F.sort_array(parts).alias("_parts"))
    first = lambda x, i: (i == 0) | (x != F.get("_parts", i - 1))
    at = F.filter(F.transform("_parts", lambda x, i: F.when(first(x, i), i)), lambda i: i.isNotNull())
    end = lambda k: F.coalesce(F.get("_at", k + 1), F.size("_parts"))
    runs = F.transform("_at", lambda i, k: F.struct(F.get("_parts", i).alias(name), (end(k) - i).cast("long").alias("n")))
    return row.withColumn("_at", at).select(*keep, F.explode(runs).alias("_r")).select(*keep, "_r.*")


def printed_core(printed: Column) -> Column:
    """The digits of a printed value: no bound or sign in front, no currency unit behind."""
    s = F.regexp_replace(F.regexp_replace(printed, "–", "-"), r"^[<>≈約\-—]+", "")
    return F.regexp_replace(F.regexp_replace(s, "元$", ""), "-", "")


#: Stands for a found value; a private-use character, which texts have no use for.
_FOUND = "\ue000"


def _stands_alone(hay: Column, needle: Column) -> Column:
    """Does the value occur with no digit or point in front and no digit behind?

    Occurrences are marked by a literal replacement, and constant patterns look at the characters around a mark: nothing
    in the value is ever read as a pattern. Where values touch, a mark's neighbour is the value's own end or beginning.
    """
    clean = lambda c: F.replace(c, F.lit(_FOUND), F.lit("\ue001"))
    value = clean(needle)
    marked = F.replace(clean(hay), value, F.lit(_FOUND))
    digit_first, digit_last = value.rlike("^[0-9]"), value.rlike("[0-9.]$")
    test = lambda before, behind: marked.rlike(f"(?<![0-9.{before}]){_FOUND}(?![0-9{behind}])")
    alone = (
        F.when(digit_first & digit_last, test(_FOUND, _FOUND)).when(digit_first, test("", _FOUND))
        .when(digit_last, test(_FOUND, "")).otherwise(test("", ""))
    )
    n = F.length(value)
    # a value that can overlap itself may stand alone inside a run of its own: these few are looked at place by place
    folds = (n > 1) & F.exists(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda p: F.right(value, n - p) == F.left(value, n - p))
    near = lambda i: F.substring(clean(hay), i - 1, F.lit(1))
    everywhere = F.exists(
        F.sequence(F.lit(1), F.greatest(F.length(hay), F.lit(1))),
        lambda i: (F.substring(clean(hay), i, n) == value) & ~((i > 1) & near(i).rlike("[0-9.]")) & ~F.substring(clean(hay), i + n, F.lit(1)).rlike("[0-9]"),
    )
    return F.when(n == 0, F.lit(True)).when(~F.contains(hay, needle), F.lit(False)).when(alone, F.lit(True)).when(folds, everywhere).otherwise(F.lit(False))


def literal_in_text(
    printed: Column, text: Column, boundary: bool = False, normalised: Column | None = None
) -> Column:
    """Does the printed value occur in the text, with or without its 億 unit?

    A plain `0` is found in any text with a zero. With `boundary` the match may
    not continue a longer number, so `47%` is not found inside `147%`. Pass the
    text's `text_norm` as a column of its own to normalise a long text once.
    """
    core = printed_core(printed)
    hay = text_norm(text) if normalised is None else normalised

    def found(needle: Column) -> Column:
        return _stands_alone(hay, needle) if boundary else F.contains(hay, needle)

    without_unit = core.contains("億") & found(text_norm(F.replace(core, F.lit("億"), F.lit(""))))
    return F.when(core == "0", F.contains(text, F.lit("0"))).otherwise(found(text_norm(core)) | without_unit)


def _referred(ref: Column) -> Column:
    """The character a reference stands for; null if there is none."""
    names = {n: chr(c) for n, c in name2codepoint.items()} | _PLAIN
    table = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    body = F.substring(ref, 2, 64)
    body = F.substring_index(body, ";", 1)
    hexadecimal = F.when(F.lower(body).startswith("#x"), F.substring(body, 3, 6)).when(
        body.startswith("#"), F.hex(F.substring(body, 2, 7).cast("long"))
    )
    code = F.lpad(F.upper(hexadecimal), 8, "0")
    valid = ((code < "0000D800") | (code > "0000DFFF")) & (code <= "0010FFFF") & (code > "00000000")
    char = F.when(valid, F.decode(F.unhex(code), "UTF-32"))
    char = F.when(char == "\u00a0", F.lit(" ")).otherwise(char)
    return F.when(body.startswith("#"), char).otherwise(F.element_at(table, body))


def unescape(c: Column) -> Column:
    """Decode character references; those of the ampersand last, so that nothing is decoded twice."""
    refs = F.array_distinct(F.regexp_extract_all(c, F.lit(_REFERENCE), F.lit(0)))
    refs = F.concat(F.filter(refs, lambda r: ~_ampersand(r)), F.filter(refs, _ampersand))
    done = F.aggregate(refs, c, lambda s, r: F.replace(s, r, F.coalesce(_referred(r), r)))
    return F.when(c.contains("&"), done).otherwise(c)


def _ampersand(ref: Column) -> Column:
    return F.lower(ref).rlike("^&(amp|#0*38|#x0*26);$")


def strip_tags(c: Column) -> Column:
    return F.regexp_replace(c, _TAG, " ")


def tag_text(c: Column) -> Column:
    """Text of a piece of a page: tags stripped, references decoded."""
    return unescape(strip_tags(c))


def drop_page_chrome(html: Column) -> Column:
    """Remove scripts, styles, navigation and comments before looking at the text."""
    out = F.regexp_replace(html, _COMMENT, "")
    for name in _CHROME:
        out = F.regexp_replace(out, rf"(?is)<{name}\b.*?</{name}\s*>", "")
    return out


def page_title(html: Column) -> Column:
    return unescape(collapse_ws(F.regexp_extract(html, r"(?is)<title\b[^>]*>(.*?)</title>", 1)))


def page_paragraphs(html: Column) -> Column:
    """ARRAY<STRING> of paragraph texts; a paragraph ends where the next one opens."""
    pieces = F.split(drop_page_chrome(html), r"(?i)<p(?:\s[^>]*)?>")
    texts = F.transform(
        F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))),
        lambda p: unescape(collapse_ws(strip_tags(p))),
    )
    return F.filter(texts, lambda p: p != "")


def page_text(html: Column) -> Column:
    return F.array_join(page_paragraphs(html), "\n")


def content_hash(c: Column) -> Column:
    return F.sha2(c.cast("binary"), 256)


# ---------------------------------------------------------------- URLs


def url_host(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#:]+)", 1)


def host_has_suffix(host: Column, suffix: str) -> Column:
    """The host itself or any sub-domain of `suffix`."""
    return (host == suffix) | host.endswith("." + suffix)


def url_last_id(url: Column) -> Column:
    """Id of an article URL: last path segment up to its first dot."""
    last = F.element_at(F.split(F.rtrim(url, F.lit("/")), "/"), -1)
    return F.element_at(F.split(last, r"\."), 1)


def url_safe_key(url: Column, width: int = 120) -> Column:
    rest = F.regexp_replace(url, r"^.*?//", "")
    return F.substring(F.regexp_replace(rest, "[^A-Za-z0-9]+", "_"), 1, width)


def same_url(a: Column, b: Column) -> Column:
    """Equality that ignores a trailing slash."""
    return F.rtrim(a, F.lit("/")) == F.rtrim(b, F.lit("/"))
