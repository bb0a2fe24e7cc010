"""Column -> Column helpers.

All built from ``pyspark.sql.functions`` so they stay inside whole-stage
codegen; no Python UDFs.  ANSI mode is on, so array access uses ``get`` /
``try_element_at`` and division uses ``try_divide``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values that results depend on -------------------------------------
TOPIC_PREFIX = "TOPIC:"
FACT_PREFIX = "FACT:"
NONE_MARK = "NONE"
BULLET_PREFIXES = ("- ", "* ")
NUMBERED_ITEM = r"^\d+[.)]\s+"
MIN_ITEM_LENGTH = 3          # list items must be longer than this
MIN_FACT_LENGTH = 10         # facts must be longer than this
CHUNK_SIZE = 800
CHUNK_STEP = 700
# ------------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Python ``str.strip()``: drop leading/trailing whitespace of any kind."""
    return F.regexp_replace(_c(c), r"^\s+|\s+$", "")


def fingerprint_code(c) -> Column:
    """second '/'-part, last three characters, upper case.

    Shorter parts are upper-cased whole; text without '/' is returned
    unchanged; NULL stays NULL (the reference turns it into 'nan').
    """
    c = _c(c)
    parts = F.split(c, "/", -1)
    return F.when(F.size(parts) >= 2, F.upper(F.right(F.get(parts, 1), F.lit(3)))).otherwise(c)


def path_segment(c) -> Column:
    """second '/'-part, else the text; NULL and '' unchanged."""
    c = _c(c)
    return F.coalesce(F.get(F.split(c, "/", -1), 1), c)


def _json_list(c: Column) -> Column:
    parsed = F.from_json(F.regexp_replace(c, "'", '"'), "array<string>")
    return F.filter(parsed, lambda x: x.isNotNull())


def _json_scalar(c: Column) -> Column:
    """The text of a JSON string, else NULL (the same quotes rule as lists)."""
    quoted = F.replace(strip(c), F.lit("'"), F.lit('"'))
    return F.when(quoted.rlike(r'(?s)^".*"$'), F.get_json_object(F.concat(F.lit('{"x":'), quoted, F.lit("}")), "$.x"))


def parse_list(c) -> Column:
    """list text -> array<string> (report dialect).

    NULL -> []; JSON list after ' -> " -> its items; anything else -> the raw
    text as one item, or [] when it is blank.
    """
    c = _c(c)
    fallback = F.when(strip(c) == "", F.array().cast("array<string>")).otherwise(F.array(F.coalesce(_json_scalar(c), c)))
    return F.when(c.isNull(), F.array().cast("array<string>")).otherwise(
        F.coalesce(_json_list(c), fallback))


def parse_list_keep_blank(c) -> Column:
    """as F02 but blank text is kept as one item."""
    c = _c(c)
    return F.when(c.isNull(), F.array().cast("array<string>")).otherwise(
        F.coalesce(_json_list(c), F.array(F.coalesce(_json_scalar(c), c))))


def clean_empty_list(c) -> Column:
    """P02: '[]' and '[ ]' become ''."""
    c = _c(c)
    return F.when(c.isin("[]", "[ ]"), F.lit("")).otherwise(c)


def parse_list_analyzer(c) -> Column:
    """analyzer dialect.  NULL, '' and '[]' -> []; bracketed text -> JSON
    list ([] when it does not parse, see :func:`list_parse_error`); otherwise
    split on ',', trim, drop empty items.  Text is never evaluated as code.
    """
    c = _c(c)
    empty = F.array().cast("array<string>")
    split = F.filter(F.transform(F.split(c, ","), lambda x: strip(x)), lambda x: x != "")
    return (F.when(c.isNull() | c.isin("", "[]"), empty)
            .when(c.rlike(r"(?s)^\[.*\]$"), F.coalesce(_json_list(c), empty))
            .otherwise(split))


def list_parse_error(c) -> Column:
    """True where F04 met bracketed text that is not a JSON list."""
    c = _c(c)
    return F.coalesce(c.rlike(r"(?s)^\[.*\]$") & ~c.isin("[]") & _json_list(c).isNull(), F.lit(False))


def list_text(arr) -> Column:
    """Inverse of F02: array -> "['a', 'b']" text."""
    return F.concat(F.lit("["), F.array_join(F.transform(_c(arr), lambda x: F.concat(F.lit("'"), x, F.lit("'"))), ", "), F.lit("]"))


def short_label(c) -> Column:
    """last '.'-part, first 15 characters."""
    return F.substring(F.substring_index(_c(c), ".", -1), 1, 15)


def int_percent(a, b) -> Column:
    """F16: a*100 // max(b, 1) on integers, not negative (integer division)."""
    return F.call_function("div", _c(a) * 100, F.greatest(_c(b), F.lit(1)))


def trunc_div(a: str, b: str) -> Column:
    """integer division toward zero (SQL ``div``); NULL for a zero divisor.

    ``a`` and ``b`` are column names or SQL expressions.
    """
    return F.expr(f"CASE WHEN ({b}) <> 0 THEN ({a}) div ({b}) END")


def list_item(line, prefix: str = TOPIC_PREFIX) -> Column:
    """one list item from a line, or NULL.

    Accepted shapes (after stripping): ``<prefix> item`` (every occurrence of
    the prefix is removed), ``- item`` / ``* item`` and ``1. item`` / ``1) item``.
    Items must be longer than three characters.
    """
    s = strip(line)
    item = (F.when(s.startswith(prefix), strip(F.replace(s, F.lit(prefix), F.lit(""))))
            .when(s.startswith(BULLET_PREFIXES[0]) | s.startswith(BULLET_PREFIXES[1]), strip(F.substring(s, 3, 1 << 30)))
            .when(s.rlike(NUMBERED_ITEM), strip(F.regexp_replace(s, NUMBERED_ITEM, ""))))
    return F.when(F.length(item) > MIN_ITEM_LENGTH, item)


def chunk_starts(text, step: int = CHUNK_STEP) -> Column:
    """0-based start offsets 0, step, 2*step, ... below len(text); [] for ''."""
    n = F.length(_c(text))
    return F.when(n > 0, F.sequence(F.lit(0), n - 1, F.lit(step))).otherwise(F.array().cast("array<int>"))


def chunks(text, size: int = CHUNK_SIZE, step: int = CHUNK_STEP) -> Column:
    """character chunks ``text[i:i+size]`` for i in range(0, len, step)."""
    t = _c(text)
    return F.transform(chunk_starts(t, step), lambda i: F.substring(t, i + 1, size))


def content_hash(c) -> Column:
    """SHA-256 hex of the text."""
    return F.sha2(_c(c), 256)


def anagram_key(c) -> Column:
    """the word's characters sorted (Unicode characters, not bytes)."""
    return F.array_join(F.array_sort(F.split(_c(c), "")), "")


def brackets_balanced(c) -> Column:
    """'()[]{}' nest properly and nothing else appears; '' passes.

    A fold over the characters with a stack kept as a string; a bad
    character or a mismatched close poisons the stack with '!'.
    """
    chars = F.split(_c(c), "")

    def step(acc, ch):
        top = F.substring(acc, -1, 1)
        pop = F.substring(acc, 1, F.length(acc) - 1)
        return (F.when(acc == "!", acc)
                .when(ch.isin("(", "[", "{"), F.concat(acc, ch))
                .when((ch == ")") & (top == "("), pop)
                .when((ch == "]") & (top == "["), pop)
                .when((ch == "}") & (top == "{"), pop)
                .otherwise(F.lit("!")))

    return F.aggregate(F.filter(chars, lambda x: x != ""), F.lit(""), step) == ""


def bracket_chars(c) -> Column:
    """Keep only the bracket characters of a text (for F15 as a text check)."""
    return F.regexp_replace(_c(c), r"[^()\[\]{}]", "")


def insight_sections(c) -> Column:
    """split insight text at blank lines or before a '**' line."""
    return F.split(_c(c), r"\n\n+|\n(?=\*\*)")


# fixed value: the report's long US date format
LONG_US_DATE = "MMMM d, yyyy"


def long_us_date(c) -> Column:
    """'December 2, 2026' style date text."""
    return F.date_format(_c(c), LONG_US_DATE)
