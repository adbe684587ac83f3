"""DuckDB SQL of the queries of this subpackage that SQL can express."""

from __future__ import annotations

OP7 = r"""
WITH text_words AS (
  SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark
), words AS (
  SELECT kind, id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM text_words
), items AS (
  SELECT id AS item_id, w, least(len(w), 13) AS size FROM words WHERE kind = 'b' AND len(w) > 0
), item_windows AS (
  SELECT DISTINCT item_id, size, w[p:p + size - 1] AS win
  FROM (SELECT item_id, w, size, unnest(range(1, len(w) - size + 2)) AS p FROM items)
), sizes AS (SELECT DISTINCT size FROM items),
found AS (
  SELECT s.id AS doc_id, s.p, s.size, i.item_id
  FROM (SELECT id, size, p, w[p:p + size - 1] AS win FROM (
          SELECT id, w, size, unnest(range(1, len(w) - size + 2)) AS p
          FROM words, sizes WHERE kind = 'd' AND len(w) >= size)) s
  JOIN item_windows i ON i.size = s.size AND i.win = s.win
), hit AS (
  SELECT doc_id, count(DISTINCT word) AS n_hit
  FROM (SELECT doc_id, unnest(range(p, p + size)) AS word FROM found) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
)
SELECT w.id AS doc_id, len(w.w) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(n.n_items, 0) AS n_items,
       sha256(coalesce(n.items, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AND 20 * coalesce(h.n_hit, 0) >= len(w.w) AS contaminated
FROM words w LEFT JOIN hit h ON h.doc_id = w.id LEFT JOIN named n ON n.doc_id = w.id
WHERE w.kind = 'd'
"""

OP8 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
         vec_id, score FROM scored
)
SELECT * FROM ranked WHERE rank <= 5
"""


#: crc_table.t: the remainders of all bytes, worked out bit by bit.
_BITS = "SELECT i, i AS x FROM (SELECT unnest(range(256)) AS i)"
for _ in range(8):
    _BITS = f"SELECT i, CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END AS x FROM ({_BITS})"
_CRC_TABLE = f"crc_table AS (SELECT list(x ORDER BY i) AS t FROM ({_BITS}))"


def _crc32(text: str) -> str:
    """Unsigned crc32 of the UTF-8 of ``text``, where crc_table is joined."""
    code = f"hex(encode({text}))"
    octets = f"list_transform(range(0, length({code}) // 2), lambda k: CAST('0x' || substr({code}, CAST(2 * k + 1 AS BIGINT), 2) AS BIGINT))"
    step = "xor(c >> 8, t[xor(c, b) % 256 + 1])"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {octets}), lambda c, b: {step}), 4294967295)"


OP11 = f"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents
), hashed AS (
  SELECT run, {_crc32("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run")} AS h FROM runs, crc_table WHERE length(run) >= 7
), results AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed
), words AS (
  SELECT word, count(*) AS n FROM results WHERE length(word) >= 7 GROUP BY word HAVING count(*) >= 2
), cuts AS (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest
  FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM words)
), pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.i = b.i WHERE a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON a.rest = b.word
), ranked AS (
  SELECT p.word, near, near_n, count(*) OVER (PARTITION BY p.word) AS n_near,
         row_number() OVER (PARTITION BY p.word ORDER BY near_n DESC, near) AS place, w.n FROM pairs p JOIN words w ON w.word = p.word
), best AS (SELECT * FROM ranked WHERE place = 1),
forms AS (SELECT word, near AS form, near_n AS form_n FROM best WHERE near_n >= 10 * n),
ways AS (
  SELECT word, word AS root, 0 AS steps FROM words
  UNION ALL SELECT y.word, f.form, steps + 1 FROM ways y JOIN forms f ON f.word = y.root
), roots AS (SELECT word, arg_max(root, steps) AS root FROM ways GROUP BY word)
SELECT w.word, f.form, r.root, w.n, coalesce(b.n_near, 0) AS n_near, f.form_n
FROM words w JOIN roots r ON r.word = w.word LEFT JOIN best b ON b.word = w.word LEFT JOIN forms f ON f.word = w.word
"""


def merkle_sql(doc_levels: int = 24, lang_levels: int = 10) -> str:
    """Serves up to 2 ** doc_levels documents of a lang, 2 ** lang_levels langs."""

    def tree(name: str, leaves: str, part: str, levels: int) -> str:
        """Tables name0, name1, ... (part, p, h): the levels of each part's tree,
        those of parts with one node left are empty."""
        out = [f"{name}0 AS MATERIALIZED ({leaves})"]
        for k in range(1, levels + 1):
            many = f"(SELECT *, count(*) OVER (PARTITION BY {part}) AS m FROM {name}{k - 1})"
            out.append(f"{name}{k} AS MATERIALIZED (SELECT {part}, p // 2 AS p, sha256(string_agg(h, '' ORDER BY p)) AS h FROM {many} WHERE m > 1 GROUP BY {part}, p // 2)")
        tops = " UNION ALL ".join(f"SELECT {part}, h, {k} AS k FROM {name}{k}" for k in range(levels + 1))
        out.append(f"{name}_top AS (SELECT {part}, arg_max(h, k) AS h, max(k) AS height FROM ({tops}) GROUP BY {part})")
        return ",\n".join(out)

    def climb(name: str, start: str, trees: str, part: str, levels: int) -> str:
        """Tables name0, name1, ...: the rows with siblings ``sibs`` so far and
        the folded digest ``acc``."""
        out = [f"{name}0 AS ({start})"]
        for k in range(levels):
            fold = "CASE WHEN y.h IS NULL THEN sha256(x.acc) WHEN y.p < x.p THEN sha256(y.h || x.acc) ELSE sha256(x.acc || y.h) END"
            out.append(
                f"{name}{k + 1} AS (SELECT x.* EXCLUDE (p, sibs, acc), x.p // 2 AS p, x.sibs || coalesce(y.h, '') AS sibs, "
                f"CASE WHEN {k} < x.height THEN {fold} ELSE x.acc END AS acc "
                f"FROM {name}{k} x LEFT JOIN {trees}{k} y ON y.{part} IS NOT DISTINCT FROM x.{part} AND y.p = xor(x.p, 1) AND {k} < x.height)"
            )
        return ",\n".join(out)

    def field(value: str) -> str:
        return f"coalesce(CAST(octet_length(encode({value})) AS VARCHAR) || ':' || {value}, '-')"

    def leaf(n_chars: str) -> str:
        fields = ["CAST(doc_id AS VARCHAR)", "source", "lang", f"CAST({n_chars} AS VARCHAR)", "text"]
        return f"sha256({' || '.join(map(field, fields))})"

    tampered = f"coalesce({_crc32('CAST(doc_id AS VARCHAR)')} % 7 = 0, false)"
    return f"""
WITH {_CRC_TABLE},
leaves AS MATERIALIZED (
  SELECT doc_id, lang, {leaf('n_chars')} AS h, CASE WHEN {tampered} THEN {leaf('(n_chars + 1)')} ELSE {leaf('n_chars')} END AS checked
  FROM documents, crc_table
), placed AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, h) - 1 AS p FROM leaves),
{tree("d", "SELECT lang, p, h FROM placed", "lang", doc_levels)},
langs AS MATERIALIZED (SELECT 0 AS one, lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS p FROM d_top),
{tree("g", "SELECT one, p, h FROM langs", "one", lang_levels)},
{climb("u", "SELECT x.doc_id, x.lang, x.h AS leaf, t.h AS subroot, t.height, x.p, '' AS sibs, x.checked AS acc FROM placed x JOIN d_top t ON t.lang IS NOT DISTINCT FROM x.lang", "d", "lang", doc_levels)},
{climb("v", f"SELECT x.* EXCLUDE (p, height), l.one, l.p, t.height, t.h AS root FROM u{doc_levels} x JOIN langs l ON l.lang IS NOT DISTINCT FROM x.lang JOIN g_top t ON t.one = l.one", "g", "one", lang_levels)}
SELECT doc_id, leaf, subroot, root, sha256(sibs) AS proof_sha256, acc AS folded_root, acc = root AS verified FROM v{lang_levels}
"""


def oracle_queries() -> dict[str, str]:
    return {
        "op7_decontamination": OP7, "op8_mtree_topk": OP8, "op11_spelling_variants": OP11, "op13_merkle_manifest": merkle_sql(),
    }
