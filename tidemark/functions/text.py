"""Text column expressions: markup removal, tokens, per-row term counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from .stopwords import STOP_WORDS

# A token is a longest run of letters, digits and apostrophes; it
# is kept when it is all letters, at least three of them.
TOKEN_CHARACTERS = r"\p{L}\p{N}'"
KEPT_TOKEN = rf"(?<![{TOKEN_CHARACTERS}])\p{{L}}{{3,}}+(?![{TOKEN_CHARACTERS}])"

# Entity and the character it stands for; "&amp;" must be last.
ENTITIES = [
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&nbsp;", " "),
    ("&amp;", "&"),
]

_HTML_BLOCKS = [
    r"(?s)<!--.*?-->",
    r"(?is)<script\b.*?</script>",
    r"(?is)<style\b.*?</style>",
    r"(?is)<ref\b[^>]*/>",
    r"(?is)<ref\b.*?</ref>",
]
_TAG = r"(?s)<[^<>]*>"
_BLANKS = r"[ \t\r\n\f]+"


def unescaped(text: Column) -> Column:
    for entity, character in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(character))
    return text


def html_to_text(html: Column) -> Column:
    """Readable text of an HTML string, on one line."""
    for pattern in _HTML_BLOCKS:
        html = F.regexp_replace(html, pattern, " ")
    return F.trim(F.regexp_replace(unescaped(F.regexp_replace(html, _TAG, " ")), _BLANKS, " "))


def _nesting(markup: Column) -> Column:
    """The deepest nesting of templates, from one pass over their braces."""
    braces = F.regexp_extract_all(markup, F.lit(r"\{\{|\}\}"), F.lit(0))
    none = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("most"))

    def step(state: Column, brace: Column) -> Column:
        depth = F.when(brace == "{{", state["depth"] + 1).otherwise(F.greatest(state["depth"] - 1, F.lit(0)))
        return F.struct(depth.alias("depth"), F.greatest(state["most"], depth).alias("most"))

    return F.aggregate(braces, none, step, lambda state: state["most"])


def wiki_to_text(markup: Column) -> Column:
    """Readable text of wiki markup, on one line.

    Templates and tables go, innermost first, as deep as they are nested;
    links keep their visible words.
    """
    for pattern in _HTML_BLOCKS:
        markup = F.regexp_replace(markup, pattern, " ")
    levels = F.filter(F.sequence(F.lit(0), _nesting(markup)), lambda level: level > 0)
    markup = F.aggregate(levels, markup, lambda rest, _: F.regexp_replace(rest, r"\{\{[^{}]*\}\}", " "))
    markup = F.regexp_replace(markup, r"(?s)\{\|.*?\|\}", " ")
    markup = F.regexp_replace(markup, r"\[\[(?:File|Image|Category):[^\[\]]*\]\]", " ")
    markup = F.regexp_replace(markup, r"\[\[(?:[^|\[\]]*\|)?([^|\[\]]*)\]\]", "$1")
    markup = F.regexp_replace(markup, r"\[[a-z]+://[^\s\]]+ ?([^\]]*)\]", "$1")
    markup = F.regexp_replace(markup, r"(?m)^=+([^=\n]*)=+[ \t]*$", "$1")
    markup = F.regexp_replace(markup, r"'{2,}", "")
    markup = F.regexp_replace(markup, _TAG, " ")
    return F.trim(F.regexp_replace(unescaped(markup), _BLANKS, " "))


def token_list(text: Column) -> Column:
    """Lower-case words of at least three letters, in text order."""
    return F.regexp_extract_all(F.lower(text), F.lit(KEPT_TOKEN), F.lit(0))


def without_stop_words(tokens: Column, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    """The tokens that are not in a fixed, short word list."""
    reachable = [w for w in stop_words if w.isalpha() and len(w) > 2]
    return F.filter(tokens, lambda w: ~w.isin(reachable))
