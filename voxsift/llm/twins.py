"""SQL twins (DuckDB) of the manifest and of the run search, made from rules."""

from __future__ import annotations

#: crc32 of a decimal number, bit by bit (polynomial 0xEDB88320, reflected).
CRC32 = """(4294967295 - list_reduce(
    list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(CAST({0} AS VARCHAR), ''),
        lambda c: list_transform(range(8), lambda b: (ascii(c) >> b) & 1)))),
    lambda c, b: xor(c >> 1, 3988292384 * ((xor(c, b)) & 1))))"""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _tree(source: str, name: str, levels: int) -> list[str]:
    """Common table expressions that climb ``levels`` levels of the trees of
    ``source`` (g, i, d: group, place and digest): ``name``k has the runs of
    level k with their digests, ``name`` the roots."""
    out = [f"{name}_n0 AS (SELECT g, i, d, count(*) OVER (PARTITION BY g) AS n FROM {source})"]
    for k in range(levels):
        out.append(f"{name}{k} AS (SELECT g, i // 8 AS r, n, list(d ORDER BY i) AS ds FROM {name}_n{k} GROUP BY g, i // 8, n)")
        out.append(f"{name}_n{k + 1} AS (SELECT g, r AS i, CASE WHEN n > 1 THEN sha256(array_to_string(ds, '')) ELSE ds[1] END AS d, "
                   f"count(*) OVER (PARTITION BY g) AS n FROM {name}{k})")
    out.append(f"{name} AS (SELECT g, d FROM {name}_n{levels})")
    return out


def _fold(source: str, name: str, out: str, levels: int) -> list[str]:
    """Walk rows (g, i, folded, proof) up the trees of ``name``."""
    steps, last = [], source
    for k in range(levels):
        slot = f"(i // {8 ** k}) % 8"
        rest = f"array_to_string(ds[1:{slot}], '')", f"array_to_string(ds[{slot} + 2:], '')"
        steps.append(
            f"{out}{k} AS (SELECT s.* REPLACE (CASE WHEN n > 1 THEN sha256({rest[0]} || folded || {rest[1]}) ELSE folded END AS folded, "
            f"CASE WHEN n > 1 THEN proof || {rest[0]} || {rest[1]} ELSE proof END AS proof) "
            f"FROM {last} s JOIN {name}{k} t ON s.g = t.g AND s.i // {8 ** (k + 1)} = t.r)")
        last = f"{out}{k}"
    return steps


def manifest_sql(levels: int = 8, top_levels: int = 3) -> str:
    """Twin of ``op11``: up to 8 ** levels rows a lang, 8 ** top_levels langs."""
    def shown(c):
        return f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || {c} END"

    fields = " || ".join(map(shown, ("doc_id", "source", "lang", "n_chars", "text")))
    changed = fields.replace(shown("text"), shown(f"translate(text, '{UPPER}', '{LOWER}')"))
    parts = [
        f"h AS (SELECT doc_id, CASE WHEN lang IS NULL THEN '0' ELSE '1' || lang END AS g, sha256({fields}) AS leaf, "
        f"CASE WHEN {CRC32.format('doc_id')} % 3 = 0 THEN sha256({changed}) ELSE sha256({fields}) END AS folded FROM documents)",
        "l AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, '' AS proof FROM h)",
        "l0 AS (SELECT g, i, leaf AS d FROM l)", *_tree("l0", "s", levels),
        "t0 AS (SELECT 'all' AS g, row_number() OVER (ORDER BY g) - 1 AS i, d, g AS lang FROM s)",
        *_tree("(SELECT g, i, d FROM t0)", "u", top_levels), *_fold("l", "s", "f", levels),
        f"v AS (SELECT f.doc_id, f.leaf, t0.d AS subroot, t0.g, t0.i, f.folded, f.proof FROM f{levels - 1} f JOIN t0 ON f.g = t0.lang)",
        *_fold("v", "u", "w", top_levels)]
    return ("WITH " + ",\n".join(parts) + f"""
SELECT doc_id, leaf, subroot, u.d AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = u.d AS verified
FROM w{top_levels - 1}, u""")


def runs_sql() -> str:
    """Twin of ``op13``: equal words of a document pair up at all distances up
    to a quarter of its words, and pairs of one distance at consecutive
    places form stretches."""
    return rf"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS doc, {CRC32.format('doc_id')} AS h,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT *, h // 10 AS g, len(w) AS n FROM d),
a AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n ELSE n END AS a FROM p),
e AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM a),
words AS (
  SELECT doc, n, i, CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % p + 1] END AS word
  FROM (SELECT *, unnest(range(n)) AS i FROM e)),
often AS (SELECT * FROM words QUALIFY count(*) OVER (PARTITION BY doc, word) >= 4),
pairs AS (
  SELECT x.doc, x.i, y.i - x.i AS q
  FROM often x JOIN often y ON x.doc = y.doc AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
islands AS (
  SELECT doc, q, min(i) AS start, count(*) + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc, q ORDER BY i) AS island FROM pairs)
  GROUP BY doc, q, island HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS (SELECT doc, start, length, min(q) AS period FROM islands GROUP BY doc, start, length),
dropped AS (
  SELECT DISTINCT doc, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (
  SELECT doc, string_agg(word, ' ' ORDER BY i) AS text
  FROM words ANTI JOIN dropped USING (doc, i) GROUP BY doc),
best AS (
  SELECT * FROM runs
  QUALIFY row_number() OVER (PARTITION BY doc ORDER BY CAST(length AS DOUBLE) / period DESC, start, period) = 1),
every AS (
  SELECT doc, count(*) AS n_runs,
         string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS shown
  FROM runs GROUP BY doc)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, best.start, best.length, best.period,
       CAST(1000 * best.length // best.period AS BIGINT) AS exponent_milli,
       sha256(coalesce(shown, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM d LEFT JOIN every USING (doc) LEFT JOIN best USING (doc) LEFT JOIN kept USING (doc)
"""
