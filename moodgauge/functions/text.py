"""Cleaning, tagging and tokenising of post text."""

import html
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Literal replacements applied in this order before HTML entities are resolved.
REPLACEMENTS = [
    ("#39;", "'"),
    ("amp;", "&"),
    ("#146;", "'"),
    ("nbsp;", " "),
    ("#36;", "$"),
    ("\\n", "\n"),
    ("quot;", "'"),
    ("<br />", "\n"),
    ('\\"', '"'),
    ("<unk>", "u_n"),
    (" @.@ ", "."),
    (" @-@ ", "-"),
    ("\\", " \\ "),
]

# The tags that open a document and a field, and the two special vocabulary entries.
DOCUMENT_TAG = "xbos"
FIELD_TAG = "xfld"
UNKNOWN_TOKEN = "_unk_"
PAD_TOKEN = "_pad_"

LINK_PATTERN = r"(?i)(https?|ftp)://[^\s]+"
MENTION_PATTERN = r"@[\p{L}\p{N}_]*"


_LONG_REFERENCE = re.compile(r"&#([0-9]{8,});?")


def resolve_entities(text: str) -> str:
    """HTML entities resolved. A reference by a number of any length is read; beyond the last code point it is U+FFFD."""

    def shorter(found: re.Match) -> str:
        digits = found[1].lstrip("0") or "0"
        return "\ufffd" if len(digits) > 7 else f"&#{digits};"

    return html.unescape(_LONG_REFERENCE.sub(shorter, text))


@F.pandas_udf(StringType())
def _resolve_entities(texts: pd.Series) -> pd.Series:
    return texts.map(resolve_entities, na_action="ignore")


def unescape_html(text: Column) -> Column:
    """Resolve HTML entities. Only texts that hold an ampersand are sent to Python."""
    return F.coalesce(_resolve_entities(F.when(text.contains("&"), text)), text)


def replace_literals(text: Column, pairs=REPLACEMENTS) -> Column:
    for old, new in pairs:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def squeeze_spaces(text: Column) -> Column:
    return F.regexp_replace(text, "  +", " ")


def clean_post(text: Column, unescape_first: bool = False) -> Column:
    """Replacement list, entities, then runs of spaces.

    The list runs before entities are resolved, so `&#39;` becomes `&'`. With `unescape_first` the
    entities are resolved on the raw text instead.
    """
    if unescape_first:
        return squeeze_spaces(replace_literals(unescape_html(text)))
    return squeeze_spaces(unescape_html(replace_literals(text)))


def strip_links_and_mentions(text: Column) -> Column:
    """Drop links and @mentions and put single spaces between the words that stay."""
    bare = F.regexp_replace(F.regexp_replace(text, LINK_PATTERN, ""), MENTION_PATTERN, "")
    return F.trim(F.regexp_replace(bare, r"\s+", " "))


def clean_tweet(text: Column, unescape_first: bool = False) -> Column:
    """`clean_post` for tweets: links and mentions go first and `&#` loses its ampersand."""
    text = F.replace(strip_links_and_mentions(text), F.lit("&#"), F.lit("#"))
    return clean_post(text, unescape_first)


def tag_document(*fields: Column) -> Column:
    """Training text: a document tag, then every field behind a numbered field tag."""
    parts = [F.lit(f"\n{DOCUMENT_TAG}")]
    for number, field in enumerate(fields, start=1):
        parts += [F.lit(f" {FIELD_TAG} {number} "), field.cast("string")]
    return F.concat(*parts)


def tag_for_scoring(text: Column) -> Column:
    """The one-field form used when scoring: no newline in front."""
    return F.concat(F.lit(f"{DOCUMENT_TAG} {FIELD_TAG} 1 "), text)


def model_input(text: Column) -> Column:
    """The one form in which text reaches the classifier, in training and in scoring alike; null text is empty."""
    return tag_for_scoring(clean_post(F.coalesce(text, F.lit(""))))


#: What the pattern \s matches, for trimming.
WHITESPACE = " \t\n\x0b\f\r"


def words(text: Column, lower: bool = True) -> Column:
    """Whitespace tokens without empty ones."""
    bare = F.btrim(F.lower(text) if lower else text, F.lit(WHITESPACE))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, r"\s+"))


def split_label_prefix(line: Column, width: int = 10) -> tuple[Column, Column]:
    """(label, text) of a line that opens with `__label__1` (0) or another label of that width (1)."""
    label = F.when(F.substring(line, 1, width) == "__label__1", 0).otherwise(1)
    return label, line.substr(F.lit(width + 1), F.length(line))
