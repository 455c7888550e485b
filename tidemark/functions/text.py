"""Column-level text functions (JVM-side expressions, no Python UDFs).

Regular expressions avoid look-around and use explicit Unicode classes so the
same patterns run in Java regex (Spark) and RE2 (the DuckDB oracle).
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference for equal results).
# English stop-word list of the topic-model demo, in its original order.
STOP_WORDS = [
    "very", "ourselves", "am", "doesn", "through", "me", "against", "up", "just", "her", "ours",
    "couldn", "because", "is", "isn", "it", "only", "in", "such", "too", "mustn", "under", "their",
    "if", "to", "my", "himself", "after", "why", "while", "can", "each", "itself", "his", "all", "once",
    "herself", "more", "our", "they", "hasn", "on", "ma", "them", "its", "where", "did", "ll", "you",
    "didn", "nor", "as", "now", "before", "those", "yours", "from", "who", "was", "m", "been", "will",
    "into", "same", "how", "some", "of", "out", "with", "s", "being", "t", "mightn", "she", "again", "be",
    "by", "shan", "have", "yourselves", "needn", "and", "are", "o", "these", "further", "most", "yourself",
    "having", "aren", "here", "he", "were", "but", "this", "myself", "own", "we", "so", "i", "does", "both",
    "when", "between", "d", "had", "the", "y", "has", "down", "off", "than", "haven", "whom", "wouldn",
    "should", "ve", "over", "themselves", "few", "then", "hadn", "what", "until", "won", "no", "about",
    "any", "that", "for", "shouldn", "don", "do", "there", "doing", "an", "or", "ain", "hers", "wasn",
    "weren", "above", "a", "at", "your", "theirs", "below", "other", "not", "re", "him", "during", "which",
]
# Reserved vocabulary entries of the sequence-to-sequence demo (ids 0..3).
SPECIAL_TOKENS = ["_PAD", "_GO", "_EOS", "_UNK"]
PAD_ID, GO_ID, EOS_ID, UNK_ID = 0, 1, 2, 3
NUM_TOKEN = "_NUM"
# Characters the basic tokenizer deletes (CJK enumeration comma, full stop,
# comma and single quotation marks).
CJK_PUNCT = "、。，‘’"
# E-mail cleaning patterns: dates, clock times, addresses, URLs.
DATE_RE = r"[0-9]+/[0-9]+/[0-9]+"
TIME_RE = r"[0-2]?[0-9]:[0-6][0-9]"
EMAIL_RE = r"[\p{L}\p{N}_]+@[.\p{L}\p{N}_]+"
URL_RE = r"(?i)(?:https?://|www\.)[^\s]+"
NOT_LETTER_OR_SPACE_RE = r"[^\p{L} ]"
# ---------------------------------------------------------------------------


def split_words(s: Column) -> Column:
    """Split a single-spaced string on spaces, dropping empty pieces (so ''
    gives []).  The string expression is referenced once, so the regex chain
    that produces it runs once per row."""
    return F.array_remove(F.split(s, " "), "")


def _squeeze(s: Column) -> Column:
    return F.trim(F.regexp_replace(s, "  +", " "))


# The same matches as EMAIL_RE and URL_RE, in time that is linear in a word's length: an address starts at its word's
# first character, and what was passed over is not tried again.
_EMAIL = r"(?<![\p{L}\p{N}_])[\p{L}\p{N}_]++@[.\p{L}\p{N}_]++"
_URL = r"[hHwW](?i)(?:(?<=h)ttps?://|(?<=w)ww\.)[^\s]++"


def _letters(text: Column) -> Column:
    """Words of two or more letters, with spaces between and around them."""
    t = F.replace(F.replace(text, F.lit("\n"), F.lit(" ")), F.lit("-"), F.lit(" "))
    t = F.regexp_replace(t, DATE_RE, "")
    t = F.regexp_replace(t, TIME_RE, "")
    t = F.regexp_replace(t, _EMAIL, "")
    t = F.regexp_replace(t, _URL, "")
    t = F.regexp_replace(t, NOT_LETTER_OR_SPACE_RE, "")
    return F.regexp_replace(F.concat(F.lit(" "), t, F.lit(" ")), r"(?<= )\p{L}(?= )", "")


def clean_email_text(text: Column) -> Column:
    """Newline and '-' to space, drop dates, times, e-mail addresses and
    URLs, keep letters and spaces, drop one-letter words, single-space join.

    Written as a chain of regular expressions only (no lambda functions), so
    the whole step stays in generated code."""
    return _squeeze(_letters(text))


def _trie_pattern(words_: list[str]) -> str:
    """Alternation of the words arranged as a prefix tree (one branch per
    first letter), so matching costs one trie walk per word start."""
    trie: dict = {}
    for w in words_:
        node = trie
        for ch in w:
            node = node.setdefault(ch, {})
        node[""] = {}

    def emit(node: dict) -> str:
        alts = [re.escape(ch) + emit(child) for ch, child in sorted(node.items()) if ch]
        if not alts:
            return ""
        body = "(?:" + "|".join(alts) + ")"
        return body + "?" if "" in node else body

    return emit(trie)


STOP_RE = r"(?<= )" + "(?:" + _trie_pattern(STOP_WORDS) + ")" + r"(?= )"


def remove_stop_words(s: Column) -> Column:
    """Delete whole stop words from a single-spaced lower-case string."""
    return _squeeze(F.regexp_replace(F.concat(F.lit(" "), s, F.lit(" ")), STOP_RE, " "))


def stop_array() -> Column:
    return F.array(*[F.lit(w) for w in STOP_WORDS])


def words(text: Column, stop: bool = True) -> Column:
    """Cleaned, lower-cased word array without stop words (the corpus
    tokenisation used by the vocabulary, TF-IDF and topic operators)."""
    found = split_words(F.lower(_letters(text)))  # drops the empty pieces between several spaces
    return F.filter(found, lambda w: ~w.isin(STOP_WORDS)) if stop else found


def tokenize_ws(text: Column) -> Column:
    """lower-case, split on whitespace runs."""
    return split_words(F.trim(F.regexp_replace(F.lower(text), r"\s+", " ")))


def chars(text: Column) -> Column:
    """character tokens (empty strings dropped)."""
    return F.filter(F.split(text, ""), lambda c: c != "")


def basic_tokenizer(text: Column, normalize_digits: bool = True) -> Column:
    """digit runs to _NUM, delete CJK punctuation, split on whitespace.

    The demo's ASCII punctuation split re-joins its own separators, so ASCII
    punctuation is kept inside tokens.
    """
    t = F.regexp_replace(text, "[0-9]+", NUM_TOKEN) if normalize_digits else text
    t = F.translate(t, CJK_PUNCT, "")
    return split_words(F.trim(F.regexp_replace(t, r"\s+", " ")))


def sentences(text: Column) -> Column:
    """split on . ! ? and newline; trimmed, empties dropped."""
    parts = F.transform(F.split(text, r"[.!?\n]"), lambda s: F.trim(s))
    return F.filter(parts, lambda s: s != "")


def ngrams(tokens: Column, n: int) -> Column:
    """space-joined word n-grams in order."""
    if n == 1:
        return tokens
    grams = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(tokens) - n + 1, F.lit(1))),
        lambda i: F.array_join(F.slice(tokens, i, n), " "),
    )
    return F.when(F.size(tokens) >= n, grams).otherwise(F.array().cast("array<string>"))


def char_ngrams(word: Column, n: int) -> Column:
    """character n-grams of '<' + word + '>'."""
    w = F.concat(F.lit("<"), word, F.lit(">"))
    return F.transform(
        F.sequence(F.lit(1), F.greatest(F.length(w) - n + 1, F.lit(1))),
        lambda i: F.substring(w, i, n),
    )


def pad_pre(ids: Column, length: int, pad: int = PAD_ID) -> Column:
    """keep the last `length` ids and left-pad with `pad`."""
    kept = F.when(F.size(ids) > length, F.slice(ids, -length, length)).otherwise(ids)
    return F.concat(F.array_repeat(F.lit(pad), F.greatest(F.lit(length) - F.size(kept), F.lit(0))), kept)
