"""SQL fragments shared by the oracle queries (DuckDB dialect).

They spell out, in SQL, the same column expressions as
``lexicrate.functions.text``.
"""

# The same patterns as lexicrate.functions.text
ASCII_PUNCT = r"[!-/:-@\[-`{-~]"
WORD_OR_PUNCT = r"[\p{L}\p{N}_]+|[^\s\p{Z}\p{L}\p{N}_]"
VECTOR_TOKEN = r"[\p{L}\p{N}_]{2,}"
WHITESPACE = r"[\s\p{Z}]+"
SENTENCE = r"[^.!?\n]+[.!?]*"


def word_tokens(col: str) -> str:
    return (f"regexp_extract_all(lower(regexp_replace({col}, '{ASCII_PUNCT}', '', 'g')), "
            f"'{WORD_OR_PUNCT}')")


def raw_word_tokens(col: str) -> str:
    return f"regexp_extract_all(coalesce({col}, ''), '{WORD_OR_PUNCT}')"


def vector_tokens(col: str) -> str:
    return f"regexp_extract_all(lower(coalesce({col}, '')), '{VECTOR_TOKEN}')"


def whitespace_tokens(col: str) -> str:
    return (f"list_filter(regexp_split_to_array(lower(coalesce({col}, '')), '{WHITESPACE}'), "
            f"lambda x: x <> '')")


def token_set(col: str) -> str:
    return f"list_distinct({whitespace_tokens(col)})"


def first_line(col: str) -> str:
    return f"split_part({col}, chr(10), 1)"
