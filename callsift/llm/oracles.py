"""DuckDB SQL of the queries that SQL can express, written apart from the operators."""

from __future__ import annotations

from callsift.llm.quality_rules import COMMON_WORDS, Limits

_SPLIT = r"list_filter(regexp_split_to_array({0}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"
_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def near_dups(percent: int = 80) -> str:
    """Components over word bigrams, by all pairs that share one."""
    words = _SPLIT.format(_LOWER.format("coalesce(text, '')"))
    return f"""
WITH RECURSIVE w AS (SELECT doc_id, {words} AS ws FROM documents),
parts AS (SELECT doc_id, ws, unnest(range(1, greatest(len(ws), 2))) AS i FROM w WHERE len(ws) > 0),
sh AS (SELECT DISTINCT doc_id, CASE WHEN len(ws) = 1 THEN ws[1] ELSE ws[i] || ' ' || ws[i + 1] END AS s FROM parts),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
         FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM shared JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y
          WHERE 100 * c >= {percent} * (p.n + q.n - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents
          UNION SELECT r.a, l.y FROM reach r JOIN links l ON l.x = r.b),
low AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, low.m AS component_id, d.doc_id = low.m AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN low ON low.a = d.doc_id"""


def quality_rules(limits: Limits = Limits()) -> str:
    """Base counts, references and Jensen-Shannon verdicts."""

    def only(outside: str) -> str:
        return f"length(regexp_replace(t, '[^{outside}]', '', 'g'))"

    classes = [
        only("aeiou"), only("b-df-hj-np-tv-z"), only("A-Z"), only("0-9"), only(r"\x20\x09-\x0D"),
        only(""".,;:!?''"()\\-"""), only(r"\x{80}-\x{10FFFF}"),
    ]
    names = sorted(COMMON_WORDS)

    def listed(words: tuple[str, ...]) -> str:
        return "[" + ", ".join(f"'{w}'" for w in words) + "]"

    counts = ", ".join(
        f"list_transform({listed(COMMON_WORDS[n])}, lambda x: len(list_filter(lw, lambda y: y = x))) AS v_{n}"
        for n in names
    )
    rest = ", ".join(f"list_append(v_{n}, n_words - list_sum(v_{n})) AS u_{n}" for n in names)

    def sums(column: str, size: int, total: str) -> str:
        parts = ", ".join(f"sum((1000 * {column}[{k}]) // {total})" for k in range(1, size + 1))
        return f"list_transform([{parts}], lambda x: x::DOUBLE)"

    references = " UNION ALL ".join(
        f"SELECT '{n}' AS name, {sums('h', 8, 'n_chars')} AS rc, {sums(f'u_{n}', len(COMMON_WORDS[n]) + 1, 'n_words')} AS rw "
        f"FROM c WHERE lang = '{n}' AND NOT base_failed AND n_chars >= {limits.min_chars} "
        f"AND n_words >= {limits.min_words} HAVING count(*) > 0"
        for n in names
    )

    def distance(p: str, q: str) -> str:
        m = f"(({p}[k] / greatest(list_sum({p}), 1) + {q}[k] / list_sum({q})) / 2)"
        left = f"CASE WHEN {p}[k] > 0 THEN {p}[k] / list_sum({p}) * log2({p}[k] / list_sum({p}) / {m}) ELSE 0 END"
        right = f"CASE WHEN {q}[k] > 0 THEN {q}[k] / list_sum({q}) * log2({q}[k] / list_sum({q}) / {m}) ELSE 0 END"
        total = f"list_sum(list_transform(range(1, len({q}) + 1), lambda k: {left} + {right}))"
        return f"CASE WHEN list_sum({p}) > 0 THEN sqrt(greatest({total}, 0) / 2) ELSE 0 END"

    own = " ".join(f"WHEN '{n}' THEN u_{n}" for n in names)
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, {_SPLIT.format("t")} AS ws FROM d),
win AS (SELECT r, i, array_to_string(ws[i:i + 7], ' ') AS k
        FROM (SELECT r, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) > 7)),
rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, k) AS c FROM win) WHERE c > 1),
cov AS (SELECT r, count(DISTINCT i + j) AS n FROM rep, range(8) o(j) GROUP BY r),
ln AS (SELECT r, l, count(*) AS c FROM (SELECT r, unnest(string_split(t, chr(10))) AS l FROM d)
       WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY 1, 2),
dup AS (SELECT r, sum(c - 1)::BIGINT AS n FROM ln GROUP BY r),
b AS (SELECT w.r, doc_id, lang, len(ws)::BIGINT AS n_words, length(t)::BIGINT AS n_chars,
        length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
        coalesce(dup.n, 0) AS n_dup_lines, coalesce(cov.n, 0) AS n_repeat_words,
        [{", ".join(classes)}] AS g, list_transform(ws, lambda x: {_LOWER.format("x")}) AS lw
      FROM w LEFT JOIN dup USING (r) LEFT JOIN cov USING (r)),
v AS (SELECT *, list_append(g, n_chars - list_sum(g)) AS h, {counts},
        n_words < {limits.min_words_base} OR 100 * n_repeat_words > {limits.max_repeat_percent} * n_words AS base_failed FROM b),
c AS (SELECT *, {rest} FROM v),
refs AS ({references}),
far AS (SELECT r, min(s) AS s FROM (
          SELECT r, {{'z': dc + dw, 'c': dc, 'w': dw}} AS s FROM (
            SELECT r, {distance("h", "rc")} AS dc, {distance("u", "rw")} AS dw
            FROM (SELECT c.r, h, rc, rw, CASE name {own} END AS u FROM c CROSS JOIN refs))) GROUP BY r)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed
    AND NOT (n_chars >= {limits.min_chars} AND coalesce(s.c, 0) > {limits.max_char_distance})
    AND NOT (n_words >= {limits.min_words} AND coalesce(s.w, 0) > {limits.max_word_distance}) AS kept
FROM c LEFT JOIN far USING (r)"""


def _crc32(text: str) -> str:
    """Of an ASCII text, bit by bit."""
    step = "CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END"
    a_byte = f"list_reduce(list_prepend(xor(a, b), range(8)), lambda c, z: {step})"
    whole = f"list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT))"
    return f"xor(list_reduce({whole}, lambda a, b: {a_byte}), 4294967295)"


def merkle_manifest() -> str:
    """Trees level by level, then every leaf's way up with its siblings."""

    def encoded(x: str) -> str:
        text = f"CAST({x} AS VARCHAR)"
        return f"coalesce(strlen({text}) || ':' || {text}, '-')"

    def hashed(n_chars: str) -> str:
        return "sha256(" + " || ".join(map(encoded, ("doc_id", "source", "lang", n_chars, "text"))) + ")"

    def tree(name: str, leaves: str) -> str:
        return f"""
{name} AS (SELECT t, 0 AS h, i, n, d FROM {leaves}
  UNION ALL
  SELECT t, h + 1, i // 2, (n + 1) // 2, sha256(string_agg(d, '' ORDER BY i)) FROM {name} WHERE n > 1
  GROUP BY t, h, n, i // 2)"""

    return f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, *, coalesce({_crc32("CAST(doc_id AS VARCHAR)")} % 7 = 0, false) AS bad
  FROM documents),
e AS (SELECT r, doc_id, lang, coalesce('=' || lang, '-') AS t, {hashed("n_chars")} AS leaf,
        CASE WHEN bad THEN {hashed("n_chars + 1")} ELSE {hashed("n_chars")} END AS claimed FROM d),
l AS (SELECT *, leaf AS d, row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
        count(*) OVER (PARTITION BY t) AS n FROM e),
{tree("low", "l").strip()},
sub AS (SELECT t, d, max(h) OVER (PARTITION BY t) AS top, h FROM low),
subroots AS (SELECT t AS s, '*' AS t, d, top, row_number() OVER (ORDER BY t) - 1 AS i, count(*) OVER () AS n
  FROM sub WHERE h = top),
{tree("high", "subroots").strip()},
way AS (
  SELECT r, x.t, x.i, x.n, 0 AS h, false AS upper, claimed AS f, '' AS proof, leaf FROM l x
  UNION ALL
  SELECT r, w.t, w.i // 2, (w.n + 1) // 2, w.h + 1, false,
    sha256(CASE WHEN s.d IS NULL THEN f WHEN w.i % 2 = 1 THEN s.d || f ELSE f || s.d END),
    proof || coalesce(s.d, ''), leaf
  FROM way w LEFT JOIN low s ON s.t = w.t AND s.h = w.h AND s.i = xor(w.i, 1) WHERE w.n > 1),
mid AS (SELECT r, u.i, u.n, f, proof, leaf, u.d AS subroot FROM way w JOIN subroots u ON u.s = w.t AND u.top = w.h),
up AS (
  SELECT r, i, n, 0 AS h, f, proof, leaf, subroot FROM mid
  UNION ALL
  SELECT r, w.i // 2, (w.n + 1) // 2, w.h + 1,
    sha256(CASE WHEN s.d IS NULL THEN f WHEN w.i % 2 = 1 THEN s.d || f ELSE f || s.d END),
    proof || coalesce(s.d, ''), leaf, subroot
  FROM up w LEFT JOIN high s ON s.h = w.h AND s.i = xor(w.i, 1) WHERE w.n > 1),
root AS (SELECT d AS root FROM high WHERE n = 1)
SELECT doc_id, up.leaf, subroot, root, sha256(proof) AS proof_sha256, f AS folded_root, f = root AS verified
FROM up JOIN e USING (r) CROSS JOIN root WHERE up.n = 1"""


def centroid_clustering(k: int = 8, rounds: int = 10, d: int = 64) -> str:
    """Every round as a step of its own, all distances measured."""
    far = (
        "list_sum(list_transform(range(1, {d} + 1), lambda q: (v[q] - c[q]) * (v[q] - c[q])))::BIGINT"
    ).format(d=d)
    floored = "list_transform(range(1, {d} + 1), lambda q: (s[q] - ((s[q] % n) + n) % n) // n)".format(d=d)
    sums = ", ".join(f"sum(v[{q}])::BIGINT" for q in range(1, d + 1))
    steps = []
    for t in range(rounds + 1):
        steps.append(
            f"a{t} AS MATERIALIZED (SELECT r, min({{'f': {far}, 'j': j}}) AS b FROM x CROSS JOIN c{t} GROUP BY r)"
        )
        if t < rounds:
            steps.append(f"""s{t} AS (SELECT b.j AS j, count(*) AS n, [{sums}] AS s FROM a{t} JOIN x USING (r) GROUP BY 1),
c{t + 1} AS MATERIALIZED (SELECT c.j, CASE WHEN s IS NULL THEN c ELSE {floored} END AS c
  FROM c{t} c LEFT JOIN s{t} s ON s.j = c.j)""")
    last = f"a{rounds}"
    return f"""
WITH x AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id,
    list_transform(embedding, lambda y: floor(1024 * y::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE len(embedding) = {d} AND len(list_filter(embedding, lambda y: isfinite(y))) = {d}),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('3:' || coalesce(vec_id::VARCHAR, '')), v) - 1 AS j, v AS c FROM x
  QUALIFY row_number() OVER (ORDER BY sha256('3:' || coalesce(vec_id::VARCHAR, '')), v) <= {k}),
{", ".join(steps)}
SELECT vec_id, b.j::INT AS cluster, b.f AS distance, (sum(b.f) OVER (PARTITION BY b.j))::BIGINT AS cluster_inertia,
  (sum(b.f) OVER ())::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM {last} JOIN x USING (r) JOIN c{rounds} c ON c.j = b.j"""
