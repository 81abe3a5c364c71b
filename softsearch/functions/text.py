"""Text cleaning as native string expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from softsearch.config import DEFAULTS

# The words that start a header line of a mail or news post.
HEADER_WORDS = (
    "From", "Subject", "Organization", "Lines", "Message-ID", "NNTP-Posting-Host",
    "Distribution", "Newsgroups", "Path", "Date", "Xref", "Article-I.D.", "Reply-To",
    "Summary", "Keywords", "Expires", "Followup-To", "Sender", "References",
)
# What marks a line as quoted or as the attribution of a quote.
QUOTE_MARKS = (
    "writes in", "writes:", "wrote:", "says:", "said:", "^In article", "^Quoted from", r"^\|", "^>",
)
NO_RESULT = "No relevant documents found."

# White space in the Unicode sense plus the four ASCII separators Java leaves out.
_WS = r"\s\x1c-\x1f"
_HEADER_ALTERNATIVES = "|".join(w.replace(".", r"\.") for w in HEADER_WORDS)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_header_lines(c: Column | str, strict: bool = False) -> Column:
    """Drop newline-terminated lines that start with a header word.

    The word is only a prefix ("Fromage ..." goes too) unless ``strict`` asks for a colon.
    """
    colon = ":" if strict else ""
    return F.regexp_replace(_col(c), rf"(?imud)^(?:{_HEADER_ALTERNATIVES}){colon}[^\n]*\n", "")


def strip_quoted_lines(c: Column | str) -> Column:
    """Empty lines that start with ``>``; their newline stays."""
    return F.regexp_replace(_col(c), r"(?md)^>.*$", "")


def blank_emails(c: Column | str) -> Column:
    """Replace every run of non-space characters that holds an address by a space.

    Anchored at the start of the run and with a possessive scan to the first usable ``@``,
    so one very long run costs linear time; texts without any ``@`` skip the search.
    """
    c = _col(c)
    blanked = F.regexp_replace(c, rf"(?U)(?<![^{_WS}])[^{_WS}][^{_WS}@]*+@[^{_WS}]+\.[^{_WS}]+", " ")
    return F.when(F.contains(c, F.lit("@")), blanked).otherwise(c)


def blank_punctuation(c: Column | str) -> Column:
    """Replace what is neither letter, number, underscore nor white space by a space."""
    return F.regexp_replace(_col(c), rf"(?U)[^\p{{L}}\p{{N}}_{_WS}]", " ")


def collapse_space(c: Column | str) -> Column:
    return F.btrim(F.regexp_replace(_col(c), rf"(?U)[{_WS}]+", " "))


def truncate(c: Column | str, max_chars: int = DEFAULTS.truncate_chars) -> Column:
    """The first ``max_chars`` code points."""
    return F.substring(_col(c), 1, max_chars)


def clean_text(
    c: Column | str, max_chars: int | None = None, strict_headers: bool = False
) -> Column:
    """All cleaning steps in order, over the whole text; the result is cut if ``max_chars`` says so.

    Blanking punctuation and collapsing white space are one step here: a run of anything
    but word characters becomes one space.
    """
    c = blank_emails(strip_quoted_lines(strip_header_lines(c, strict_headers)))
    cleaned = F.btrim(F.regexp_replace(c, r"[^\p{L}\p{N}_]+", " "))
    return cleaned if max_chars is None else truncate(cleaned, max_chars)


def text_hash(c: Column | str) -> Column:
    """Short id for display and joins by hand: 16 hex digits of the SHA-256 of the UTF-8 text.
    Whether texts are equal is decided by all of it, see ``load_corpus``."""
    return F.substring(F.sha2(_col(c), 256), 1, 16)


def long_enough(c: Column | str, min_chars: int = DEFAULTS.min_chars) -> Column:
    return F.char_length(_col(c)) >= min_chars


def snippet(c: Column | str, chars: int = DEFAULTS.snippet_chars) -> Column:
    return F.substring(_col(c), 1, chars)


def strip_post_header(c: Column | str) -> Column:
    """Keep what follows the first blank line; nothing if there is none."""
    c = _col(c)
    gap = F.locate("\n\n", c)
    return F.when(gap > 0, F.substr(c, gap + 2)).otherwise("")


def strip_post_footer(c: Column | str) -> Column:
    """Cut at the last line that is blank or all dashes, unless it is the first line."""
    c = _col(c)
    body = F.regexp_replace(c, rf"(?Ud)^[{_WS}]+|[{_WS}]+\z", "")
    lines = F.split(body, "\n")
    is_rule = lambda line: line.rlike(rf"(?U)^[{_WS}]*-*[{_WS}]*\z")
    last = F.array_max(F.transform(lines, lambda line, i: F.when(is_rule(line), i).otherwise(-1)))
    return F.when(last > 0, F.array_join(F.slice(lines, F.lit(1), last), "\n")).otherwise(c)


def strip_post_quotes(c: Column | str) -> Column:
    """Drop quoted lines and the lines that introduce a quote."""
    marks = "|".join(QUOTE_MARKS)
    return F.array_join(F.filter(F.split(_col(c), "\n"), lambda line: ~line.rlike(marks)), "\n")


def strip_post_parts(c: Column | str) -> Column:
    """Header, then footer, then quotes, as done before the corpus is cleaned."""
    return strip_post_quotes(strip_post_footer(strip_post_header(c)))


def word_tokens(c: Column | str) -> Column:
    """Lower-cased runs of at least two word characters."""
    return F.regexp_extract_all(F.lower(_col(c)), F.lit(r"([\p{L}\p{N}_]{2,})"), F.lit(1))


def fixed3(c: Column | str) -> Column:
    """A number in [-1, 1] that was rounded to 4 decimals, printed with 3.

    Rounds the binary value itself, exact ties to even, as C's ``%.3f`` does;
    ``format_string`` would round the decimal digits half up, which differs for one value
    in ten that ends in a 5. ``|x| * 2^63`` is a whole number, so the comparison with the
    tie is exact in decimals.
    """
    c = _col(c)
    size = F.abs(c)
    n = F.round(size * 10000).cast("long")
    low, last = F.floor(n / 10), n % 10
    two63 = F.lit("9223372036854775808").cast("decimal(19,0)")
    value = (size * F.lit(float(2**63))).cast("long").cast("decimal(19,0)") * F.lit(10000).cast("decimal(5,0)")
    tie = n.cast("decimal(5,0)") * two63
    up = (last > 5) | ((last == 5) & ((value > tie) | ((value == tie) & (low % 2 == 1))))
    q = low + up.cast("long")
    sign = F.when(c < 0, "-").otherwise("")
    return F.format_string("%s%d.%03d", sign, F.floor(q / 1000), q % 1000)
