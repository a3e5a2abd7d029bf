"""DuckDB SQL fragments shared by the oracles.  They re-derive the expected
answers from the flat tables without any of the library's JSON code."""

# Fixed value: the warehouse INITCAP default delimiters (whitespace + these).
_INITCAP_CLASS = r"""[\s\[\](){}/|\\<>!?@"^#$&~_,.:;*%+-]"""


def initcap(expr: str) -> str:
    """Warehouse INITCAP: upper-case position 1 and every character after a
    delimiter, lower-case the rest."""
    return (f"(SELECT array_to_string(list_transform(range(1, length(s) + 1), lambda i: "
            f"CASE WHEN i = 1 OR regexp_matches(substr(s, i - 1, 1), '{_INITCAP_CLASS}') "
            f"THEN upper(substr(s, i, 1)) ELSE substr(s, i, 1) END), '') "
            f"FROM (SELECT lower({expr}) AS s))")


def title(expr: str) -> str:
    """Python str.title(): upper-case a character whose predecessor is not a
    cased letter, lower-case the rest."""
    return (f"(SELECT array_to_string(list_transform(range(1, length(s) + 1), lambda i: "
            r"CASE WHEN i = 1 OR regexp_matches(substr(s, i - 1, 1), '[^\p{Lu}\p{Ll}\p{Lt}]') "
            f"THEN upper(substr(s, i, 1)) ELSE substr(s, i, 1) END), '') "
            f"FROM (SELECT lower({expr}) AS s))")


CUSTOMER_OBJECTS = r"""
  SELECT c_custkey AS id,
    c_mktsegment || ' o''' || lower(c_name) AS name,
    replace(c_name, '#', '.') || '@Example.COM' AS email,
    strftime(DATE '2024-01-01' + CAST(c_custkey % 365 AS INTEGER), '%Y-%m-%d') AS signup_date,
    c_custkey % 10 AS k
  FROM customer
"""
