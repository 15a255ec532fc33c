"""DuckDB SQL for the registered queries that SQL can express."""

_TOP_K = """
WITH raw AS (
  SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum([p[1] * p[2] FOR p IN list_zip(q.v, c.v)]) AS BIGINT) AS score
  FROM raw q JOIN raw c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 100 = 0
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
         vec_id, score
  FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

_LINES = r"""
WITH cut AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS n
  FROM documents
), marked AS (
  SELECT *, NOT regexp_full_match(line, '[ \t\x0B\f\r]*') AS told FROM cut
), told AS (
  SELECT doc_id, n, line, row_number() OVER (PARTITION BY doc_id ORDER BY n) AS pos
  FROM marked WHERE told
), pairs AS (
  SELECT doc_id, pos, line, lead(line) OVER (PARTITION BY doc_id ORDER BY pos) AS following FROM told
), later AS (
  SELECT doc_id, pos
  FROM (SELECT doc_id, pos, row_number() OVER (PARTITION BY line, following ORDER BY doc_id, pos) AS copy
        FROM pairs WHERE following IS NOT NULL)
  WHERE copy > 1
), gone AS (
  SELECT DISTINCT doc_id, n FROM (
    SELECT doc_id, pos FROM later UNION SELECT doc_id, pos + 1 FROM later) JOIN told USING (doc_id, pos)
), kept AS (
  SELECT c.doc_id, string_agg(c.line, chr(10) ORDER BY c.n) AS text
  FROM cut c ANTI JOIN gone g ON c.doc_id = g.doc_id AND c.n = g.n GROUP BY c.doc_id
)
SELECT d.doc_id,
       CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(k.text, '') END AS text,
       (SELECT count(*) FROM gone g WHERE g.doc_id = d.doc_id) AS lines_removed
FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id
"""

_EMBEDDING_DEDUP = """
WITH RECURSIVE able AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0
), links AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM able a JOIN able b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))) >= 0.98
), reached AS (
  SELECT u, v FROM links UNION SELECT r.u, l.v FROM reached r JOIN links l ON r.v = l.u
), told AS (
  SELECT vec_id, (SELECT count(*) FROM links WHERE u = vec_id) AS n_links,
         least(vec_id, (SELECT min(v) FROM reached WHERE u = vec_id)) AS component_id
  FROM embeddings
)
SELECT *, coalesce(vec_id = component_id, false) AS kept FROM told
"""


def _crc32(text: str) -> str:
    """CRC-32 of the UTF-8 bytes of a non-empty string."""
    codes = f"[CAST('0x' || substr(hex({text}), CAST(2 * i - 1 AS BIGINT), 2) AS BIGINT) FOR i IN range(1, strlen({text}) + 1)]"
    bits = "list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), lambda a, b: {bits}), 4294967295)"


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _manifest() -> str:
    """Levels of the trees one by one: sources hold up to 16^5 documents here, 16^3 sources."""

    def leaf(text: str) -> str:
        fields = ["doc_id", "source", "lang", "n_chars", text]
        told = [f"coalesce(strlen(CAST({f} AS VARCHAR)) || ':' || CAST({f} AS VARCHAR), '-')" for f in fields]
        return f"sha256({' || '.join(told)})"

    parts = [
        f"""leaves AS (SELECT doc_id, coalesce('s' || source, '') AS tree, {leaf('text')} AS leaf,
        CASE WHEN {_crc32('CAST(doc_id AS VARCHAR)')} % 5 = 0 THEN {leaf(_LOWER)} ELSE {leaf('text')} END AS found
        FROM documents)""",
        """placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx
        FROM leaves)""",
        "a0 AS (SELECT tree, idx, leaf AS digest, count(*) OVER (PARTITION BY tree) AS n FROM placed)",
    ]

    def levels(name: str, height: int) -> None:
        for k in range(height):
            run = "PARTITION BY tree, idx // 16 ORDER BY idx ROWS BETWEEN"
            parts.append(
                f"""{name}p{k} AS (SELECT tree, idx, n > 1 AS up,
                coalesce(string_agg(digest, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
                coalesce(string_agg(digest, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
                FROM {name}{k})"""
            )
            parts.append(
                f"""{name}{k + 1} AS (SELECT tree, idx // 16 AS idx,
                CASE WHEN n > 1 THEN sha256(string_agg(digest, '' ORDER BY idx)) ELSE any_value(digest) END AS digest,
                (n + 15) // 16 AS n FROM {name}{k} GROUP BY tree, idx // 16, n)"""
            )

    levels("a", 5)
    parts.append(
        """b0 AS (SELECT '' AS tree, tree AS name, row_number() OVER (ORDER BY tree) - 1 AS idx, digest,
        count(*) OVER () AS n FROM a5)"""
    )
    levels("b", 3)
    parts.append(
        """f0 AS (SELECT p.doc_id, p.tree, p.idx, p.leaf, b0.digest AS subroot, b0.idx AS at,
        '' AS siblings, p.found AS x FROM placed p JOIN b0 ON b0.name = p.tree)"""
    )
    steps = [(f"ap{k}", "s.tree = f.tree", "f.idx", k) for k in range(5)] + [(f"bp{k}", "true", "f.at", k) for k in range(3)]
    for n, (level, same, place, k) in enumerate(steps):
        parts.append(
            f"""f{n + 1} AS (SELECT f.* EXCLUDE (siblings, x), siblings || s.l || s.r AS siblings,
            CASE WHEN s.up THEN sha256(s.l || x || s.r) ELSE x END AS x
            FROM f{n} f JOIN {level} s ON {same} AND s.idx = {place} // {16**k})"""
        )
    return f"""WITH {", ".join(parts)} SELECT doc_id, leaf, subroot, b3.digest AS root,
        sha256(siblings) AS proof_sha256, x AS folded_root, x = b3.digest AS verified
        FROM f{len(steps)}, b3"""


_RESAMPLING = rf"""
WITH texts AS (
  SELECT row_number() OVER () AS n, doc_id, {_LOWER} AS low FROM documents
), words AS (
  SELECT n, unnest(regexp_extract_all(low, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM texts
), wanted AS (
  SELECT unnest(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark
), buckets AS (
  SELECT word, {_crc32('word')} % 10000 AS bucket
  FROM (SELECT word FROM words UNION SELECT word FROM wanted)
), corpus AS (
  SELECT bucket, count(*) AS s FROM words JOIN buckets USING (word) GROUP BY bucket
), target AS (
  SELECT bucket, count(*) AS t FROM wanted JOIN buckets USING (word) GROUP BY bucket
), gains AS (
  SELECT bucket, CAST(floor(1000 * ln(
    ((coalesce(t, 0) + 1) * (CAST((SELECT count(*) FROM words) AS DOUBLE) + 10000))
    / ((s + 1) * (CAST((SELECT count(*) FROM wanted) AS DOUBLE) + 10000)))) AS BIGINT) AS gain
  FROM corpus LEFT JOIN target USING (bucket)
), weights AS (
  SELECT n, count(*) AS n_features, CAST(sum(gain) AS BIGINT) AS weight
  FROM words JOIN buckets USING (word) JOIN gains USING (bucket) GROUP BY n
), scored AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0)
    + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8)
    AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM texts LEFT JOIN weights USING (n)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS FIRST) AS place,
         count(*) FILTER (WHERE n_features >= 20) OVER () AS able FROM scored
)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n_features >= 20 AND place <= 10 * able // 100 THEN place END AS rank
FROM placed
"""

ORACLES: dict[str, str] = {
    "op1_top_k": _TOP_K,
    "op8_line_dedup": _LINES,
    "op11_embedding_dedup": _EMBEDDING_DEDUP,
    "op12_manifest": _manifest(),
    "op13_resampling": _RESAMPLING,
}
