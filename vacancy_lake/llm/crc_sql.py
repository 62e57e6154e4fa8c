"""CRC-32 of ids in DuckDB SQL, for the SQL that queries are compared with."""

from __future__ import annotations

#: DuckDB has no CRC-32: the table of its 256 steps is made by the polynomial, then applied to the id's digits.
_CRC = """crc_table AS (
  SELECT i, list_reduce(range(0, 8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i) AS v FROM range(0, 256) t(i)
), crc_list AS (SELECT list(v ORDER BY i) AS t FROM crc_table),
crcs AS (
  SELECT s, xor(list_reduce(list_transform(string_split(s, ''), lambda x: CAST(ord(x) AS BIGINT)),
    lambda c, x: xor(c >> 8, t[CAST(xor(c, x) & 255 AS BIGINT) + 1]), CAST(4294967295 AS BIGINT)), 4294967295) AS crc
  FROM (SELECT DISTINCT CAST({key} AS VARCHAR) AS s FROM {table}), crc_list
)"""


def crc_cte(key: str, table: str) -> str:
    return _CRC.replace("{key}", key).replace("{table}", table)
