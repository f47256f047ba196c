"""The registered queries of the corpus operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from veritab.llm import (chat_trie, embed_dedup, fingerprint, html_main, jaccard, langid, mixing, pieces,
                         secret_scan, token_store, toxicity, turn_repair, vector_codes)
from veritab.llm.common import table


def op1_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.report(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.predict(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def op3_embed_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.learn(docs))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    weight = mixing.quality_weight(table(spark, sf_dir, "labels"))
    return mixing.mix(table(spark, sf_dir, "documents"), weight).drop("text_hash", "source")


def op6_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"))


def op7_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.digest_report(table(spark, sf_dir, "documents"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(table(spark, sf_dir, "documents"))


def op9_html_main(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_main.extract(pages, html_main.learn(pages))


def op10_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edit_report(table(spark, sf_dir, "documents"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.report(table(spark, sf_dir, "embeddings"))


def op12_chat_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_trie.report(chat_trie.with_sample(table(spark, sf_dir, "conversations")))


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return turn_repair.report(turn_repair.damage(conversations), conversations)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pieces": op1_pieces,
    "op2_toxicity": op2_toxicity,
    "op3_embed_dedup": op3_embed_dedup,
    "op4_langid": op4_langid,
    "op5_mixing": op5_mixing,
    "op6_jaccard": op6_jaccard,
    "op7_token_store": op7_token_store,
    "op8_secrets": op8_secrets,
    "op9_html_main": op9_html_main,
    "op10_fingerprint": op10_fingerprint,
    "op11_vector_codes": op11_vector_codes,
    "op12_chat_trie": op12_chat_trie,
    "op13_turn_repair": op13_turn_repair,
}

_OP5 = r"""
WITH q AS (SELECT doc_id, max(quality) AS q FROM labels
           WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
d AS (SELECT documents.doc_id, source,
             len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
             CASE WHEN q IS NULL THEN 0.5::DOUBLE WHEN q >= 1 THEN 1.0::DOUBLE
                  ELSE 0.25::DOUBLE END AS w,
             (CAST('0x' || substr(md5('mix-1|' || coalesce(CAST(documents.doc_id AS VARCHAR), '')),
                                  1, 13) AS BIGINT) + 1.0::DOUBLE) / 4503599627370498.0::DOUBLE AS u
      FROM documents LEFT JOIN q ON documents.doc_id = q.doc_id),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
             [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
      FROM d GROUP BY source),
o AS (SELECT *, 3 * source_size AS cap,
             row_number() OVER (ORDER BY 3 * source_size / weight::DOUBLE, source NULLS LAST) AS pos
      FROM s),
l AS (SELECT *, (sum(source_size) OVER ()
                 - coalesce(sum(cap) OVER (ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING
                                                            AND 1 PRECEDING), 0))::DOUBLE
                / (sum(weight) OVER (ORDER BY pos ROWS BETWEEN CURRENT ROW
                                                     AND UNBOUNDED FOLLOWING))::DOUBLE AS level
      FROM o),
g AS (SELECT arg_min(level, pos) AS final FROM l WHERE level * weight <= cap),
t AS (SELECT source, source_size,
             least(cap::DOUBLE, coalesce((SELECT final FROM g) * weight, cap::DOUBLE)) AS target
      FROM l),
k AS (SELECT d.doc_id, d.size, t.source_size, t.target,
             CASE WHEN t.source_size > 0 THEN least(CAST(floor(t.target / t.source_size) AS BIGINT), 3)
                  ELSE 0 END AS epochs,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY -ln(d.u) / d.w, d.doc_id, d.size
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(epochs * size + greatest(0, least(size,
            CAST(round(target) AS BIGINT) - epochs * source_size - before)) AS BIGINT) AS taken
FROM k
"""


def _codes(round_: int) -> str:
    """Assignment to the codebooks ``b{round_}``: the least (distance, index) of all entries."""
    return f"""
a{round_} AS MATERIALIZED (
  SELECT rn, x.part, any_value(x.c) AS c,
         min({{'d': CAST(list_sum(list_transform(list_zip(x.c, b.c),
                                                 lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT),
               'e': b.entry}}) AS near
  FROM x JOIN b{round_} b ON x.part = b.part GROUP BY rn, x.part)"""


def _means(round_: int) -> str:
    """The codebooks after the assignment ``a{round_}``; entries without parts stay."""
    return f"""
s{round_} AS (SELECT part, near.e AS entry, i, CAST(sum(c[i]) AS BIGINT) AS s, count(*) AS n
       FROM (SELECT *, unnest(range(1, len(c) + 1)) AS i FROM a{round_}) u GROUP BY part, near.e, i),
m{round_} AS (SELECT part, entry, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c
       FROM s{round_} GROUP BY part, entry),
b{round_ + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(m.c, b.c) AS c
  FROM b{round_} b LEFT JOIN m{round_} m ON m.part = b.part AND m.entry = b.entry)"""


_OP11 = f"""
WITH k AS (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id NULLS LAST) AS rn,
         list_transform(embedding, lambda c: CAST(floor(256 * CAST(c AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NOT NULL AND isfinite(c))) = len(embedding)),
x AS MATERIALIZED (
  SELECT rn, part, v[part * (len(v) // 16) + 1 : (part + 1) * (len(v) // 16)] AS c
  FROM (SELECT rn, v, unnest(range(16)) AS part FROM k) u),
b0 AS (SELECT part, rn - 1 AS entry, c FROM x WHERE rn <= 64),
{_codes(0)}, {_means(0)}, {_codes(1)}, {_means(1)}, {_codes(2)},
f AS (SELECT k.vec_id, k.label, string_agg(format('{{:02x}}', near.e), '' ORDER BY part) AS code,
             CAST(sum(near.d) AS BIGINT) AS error
      FROM a2 JOIN k ON a2.rn = k.rn GROUP BY k.rn, k.vec_id, k.label),
h AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS digest FROM b2)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       digest AS codebooks_sha256
FROM f, h
"""

# crc32 bit by bit: DuckDB has no such function
_CRC = """xor(4294967295, list_reduce(list_concat([CAST(4294967295 AS BIGINT)],
         list_transform(range(1, len(key) + 1), lambda i: CAST(ord(key[i]) AS BIGINT))),
         lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
           lambda c, z: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END))))"""


def _add(state: str, cost: str, letter: str) -> str:
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}'}}"


def _step(role: str, states: tuple[str, ...]) -> str:
    """The lightest way to a state by a row that becomes ``role`` after one of ``states``."""
    if role == "s":
        return f"CASE WHEN kind = 's' THEN {_add(states[0], 'more', 'K')} ELSE big END"
    ways = [f"CASE WHEN kind = '{role}' THEN {_add(s, 'more', 'K')} ELSE {_add(s, '3 + more', 'R')} END"
            for s in states]
    return f"CASE WHEN kind = 'x' THEN big ELSE list_min([{', '.join(ways)}]) END"


# states: 0 nothing yet, 1 system, 2 user, 3 assistant; r: after a row, p: after inserts as well
_OP13 = rf"""
WITH RECURSIVE o AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
  FROM conversations),
w AS (SELECT *, {_CRC} % 20 AS roll FROM o),
d AS (SELECT conv_id, turn, CASE WHEN roll = 4 THEN 'user' ELSE role END AS role,
             CASE WHEN roll = 1 THEN '' WHEN roll = 2 THEN regexp_replace(text, '[.!?]', '', 'g')
                  ELSE text END AS text,
             unnest(CASE WHEN roll = 3 THEN [0, 1] ELSE [0] END) AS copy
      FROM w WHERE roll <> 0),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM d),
f AS (SELECT *, substr(role, 1, 1) AS own,
             CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 'blank'
                  WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                  WHEN NOT regexp_matches(text, '[.!?][ 	-
]*$') THEN 'truncated' ELSE '' END AS fault,
             lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before
      FROM n),
k AS MATERIALIZED (
  SELECT *, CASE WHEN fault IN ('blank', 'duplicate') THEN 'x' WHEN own IN ('s', 'u', 'a') THEN own
                 ELSE '.' END AS kind,
         CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS more,
         {{'c': 1000000000, 'a': ''}} AS big
  FROM f),
c AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
             count(*) FILTER (WHERE fault = 'blank') AS blank,
             count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
             count(*) FILTER (WHERE fault = 'truncated') AS truncated,
             count(*) FILTER (WHERE before || own NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
      FROM k GROUP BY conv_id),
walk AS (
  SELECT conv_id, 0 AS i, {{'c': 0, 'a': ''}} AS r0, {{'c': 1000000000, 'a': ''}} AS r1,
         {{'c': 1000000000, 'a': ''}} AS r2, {{'c': 1000000000, 'a': ''}} AS r3 FROM c
  UNION ALL
  SELECT g.conv_id, CAST(k.i AS INTEGER), {_add('p0', '4', 'D')},
         list_min([{_add('p1', '4', 'D')}, {_step('s', ('p0',))}]),
         list_min([{_add('p2', '4', 'D')}, {_step('u', ('p0', 'p1', 'p3'))}]),
         list_min([{_add('p3', '4', 'D')}, {_step('a', ('p2',))}])
  FROM (SELECT *, list_min([r3, {_add('p2', '3', 'I')}]) AS p3
        FROM (SELECT conv_id, i, r3, r0 AS p0, r1 AS p1,
                     list_min([r2, {_add('r0', '3', 'I')}, {_add('r1', '3', 'I')}, {_add('r3', '3', 'I')}]) AS p2
              FROM walk) h) g
  JOIN k ON k.conv_id IS NOT DISTINCT FROM g.conv_id AND k.i = g.i + 1),
e AS (SELECT walk.conv_id, list_min([r0, r3, {_add('r2', '3', 'I')}, {_add('r0', '6', 'II')},
                                     {_add('r1', '6', 'II')}]) AS best
      FROM walk JOIN c ON c.conv_id IS NOT DISTINCT FROM walk.conv_id AND c.n = walk.i),
l AS (SELECT *, p - count(*) FILTER (WHERE letter = 'I') OVER w AS i,
             count(*) FILTER (WHERE letter <> 'D') OVER w AS place
      FROM (SELECT conv_id, p, best.a[p] AS letter
            FROM (SELECT conv_id, best, unnest(range(1, len(best.a) + 1)) AS p FROM e) u) v
      WINDOW w AS (PARTITION BY conv_id ORDER BY p)),
t AS (SELECT l.conv_id, l.p, l.place, l.letter, k.role, k.text,
             max(CASE WHEN l.place = 1 AND l.letter = 'K' AND k.kind = 's' THEN 1 ELSE 0 END)
               OVER (PARTITION BY l.conv_id) AS lead
      FROM l LEFT JOIN k ON k.conv_id IS NOT DISTINCT FROM l.conv_id AND k.i = l.i WHERE l.letter <> 'D'),
s AS (SELECT conv_id, string_agg(
               CASE WHEN letter = 'K' THEN role WHEN (place - lead) % 2 = 1 THEN 'user' ELSE 'assistant' END
               || ':' || CASE WHEN letter = 'I' THEN '' ELSE text END, chr(10) ORDER BY p) AS lines
      FROM t GROUP BY conv_id)
SELECT ids.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank,
       coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, CAST(coalesce(best.c, 0) AS BIGINT) AS cost,
       coalesce(best.a, '') AS audit, sha256(coalesce(lines, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) ids
LEFT JOIN c ON c.conv_id IS NOT DISTINCT FROM ids.conv_id
LEFT JOIN e ON e.conv_id IS NOT DISTINCT FROM ids.conv_id
LEFT JOIN s ON s.conv_id IS NOT DISTINCT FROM ids.conv_id
"""


def _escaped_length(text: str) -> str:
    """Characters after escaping: one more for every backslash and every control string."""
    strings = ["\\", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]"]
    more = [f"(len({text}) - len(replace({text}, '{s}', ''))) // {len(s)}" for s in strings]
    return f"len({text}) + " + " + ".join(more)


_OP12 = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text))
         AS turns_sha256,
       CAST(coalesce(sum(len(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
                         FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum({_escaped_length('text')} +
                CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7
                          ELSE 17 + {_escaped_length('role')} END) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""

ORACLE_SQL: dict[str, str] = {"op5_mixing": _OP5, "op11_vector_codes": _OP11, "op12_chat_trie": _OP12,
                              "op13_turn_repair": _OP13}
