"""SQL that states each registered query independently, by brute force, over the same whole tables."""

from __future__ import annotations

LISTS, COARSE_ROUNDS = 8, 2
SEGMENTS, CODES, PQ_ROUNDS = 8, 16, 2
DIMS, K = 64, 10

BASE = """e AS MATERIALIZED (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
s AS MATERIALIZED (SELECT vec_id, list_transform(v, lambda x: x * (1 + vec_id % 7)) AS v FROM e)"""

BITS = """bits AS MATERIALIZED (
  SELECT vec_id, string_agg(CASE WHEN x > 0 THEN '1' ELSE '0' END, '' ORDER BY i)::BIT AS code,
         list(CASE WHEN x > 0 THEN 1 ELSE 0 END ORDER BY i) AS b
  FROM (SELECT vec_id, unnest(v) AS x, unnest(range(0, len(v))) AS i FROM e) GROUP BY vec_id)"""


def l2(a: str, b: str) -> str:
    return f"pow(list_distance({a}, {b}), 2)"


def ip(a: str, b: str) -> str:
    return f"list_inner_product({a}, {b})"


def unit(v: str) -> str:
    return (f"list_transform({v}, lambda x: CASE WHEN {ip(v, v)} = 0 THEN 0 "
            f"ELSE x / sqrt({ip(v, v)}) END)")


def top(pairs: str, k: int = K, order: str = "d") -> str:
    """Rank the rows (query_id, vec_id, d) of a FROM item."""
    return f"""SELECT query_id, rank, vec_id, d FROM (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY {order}, vec_id) AS rank FROM {pairs})
    WHERE rank <= {k}"""


def out(ranked: str, digits: int = 6) -> str:
    return f"SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, round(d, {digits}) AS distance FROM ({ranked})"


def pairs(score: str, queries: str = "e", base: str = "s", extra: str = "") -> str:
    return f"(SELECT q.vec_id AS query_id, b.vec_id, {score} AS d FROM {queries} q, {base} b {extra})"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def lloyd(p: str, src: str, k: int, rounds: int, segments: int = 1, width: int = DIMS) -> list[str]:
    """CTEs p_c0..p_c{rounds} (segment, cid, c): seeds by md5 of the id, then mean updates; and p_sub."""
    ctes = [
        f"""{p}_sub AS MATERIALIZED (
          SELECT vec_id, sg, v[sg * {width} + 1 : sg * {width} + {width}] AS u
          FROM {src}, (SELECT unnest(range(0, {segments})) AS sg))""",
        f"""{p}_c0 AS MATERIALIZED (
          SELECT sg, cid, u AS c FROM {p}_sub JOIN (
            SELECT vec_id, row_number() OVER (ORDER BY md5(CAST(vec_id AS VARCHAR)), vec_id) - 1 AS cid FROM {src})
          USING (vec_id) WHERE cid < {k})""",
    ]
    for r in range(rounds):
        ctes.append(f"{p}_a{r} AS MATERIALIZED ({nearest(f'{p}_sub', f'{p}_c{r}')})")
        ctes.append(f"""{p}_c{r + 1} AS MATERIALIZED (
          SELECT old.sg, old.cid, coalesce(new.c, old.c) AS c FROM {p}_c{r} old LEFT JOIN (
            SELECT sg, cid, list(m ORDER BY i) AS c FROM (
              SELECT sg, cid, i, avg(x) AS m FROM (
                SELECT sg, cid, unnest(u) AS x, unnest(range(0, len(u))) AS i FROM {p}_a{r})
              GROUP BY sg, cid, i) GROUP BY sg, cid) new USING (sg, cid))""")
    ctes.append(f"{p}_a AS MATERIALIZED ({nearest(f'{p}_sub', f'{p}_c{rounds}')})")
    return ctes


def nearest(sub: str, centres: str) -> str:
    """(vec_id, sg, u, cid) of the closest centre of each sub-vector."""
    return f"""SELECT vec_id, sg, u, cid FROM (
      SELECT x.vec_id, x.sg, x.u, y.cid,
             row_number() OVER (PARTITION BY x.vec_id, x.sg ORDER BY {l2('x.u', 'y.c')}, y.cid) AS r
      FROM {sub} x JOIN {centres} y USING (sg)) WHERE r = 1"""


def coarse() -> list[str]:
    """lists(cid, c) and assigned(vec_id, cid, v)."""
    return lloyd("ivf", "e", LISTS, COARSE_ROUNDS) + [
        f"lists AS MATERIALIZED (SELECT cid, c FROM ivf_c{COARSE_ROUNDS})",
        "assigned AS MATERIALIZED (SELECT vec_id, cid, u AS v FROM ivf_a)",
    ]


def probes(nprobe: int, queries: str = "e") -> str:
    return f"""probes AS MATERIALIZED (
      SELECT vec_id, v, cid FROM (
        SELECT q.vec_id, q.v, l.cid,
               row_number() OVER (PARTITION BY q.vec_id ORDER BY {l2('q.v', 'l.c')}, l.cid) AS r
        FROM {queries} q, lists l) WHERE r <= {nprobe})"""


def scalar(levels: int, src: str = "e") -> list[str]:
    """ranges(i, low, step) and sq(vec_id, codes, v) with v decoded."""
    return [
        f"""flat AS MATERIALIZED (
          SELECT vec_id, unnest(v) AS x, unnest(range(0, len(v))) AS i FROM {src})""",
        f"""ranges AS MATERIALIZED (
          SELECT i, min(x) AS low, (max(x) - min(x)) / {levels} AS step FROM flat GROUP BY i)""",
        f"""sqflat AS MATERIALIZED (
          SELECT vec_id, i, x, low, step,
                 least(greatest(floor((x - low) / CASE WHEN step = 0 THEN 1 ELSE step END), 0), {levels}) AS code
          FROM flat JOIN ranges USING (i))""",
        """sq AS MATERIALIZED (
          SELECT vec_id, list(code * step + (low + 0.5 * step) ORDER BY i) AS v FROM sqflat GROUP BY vec_id)""",
    ]


def adc(p: str, queries: str, rounds: int) -> str:
    """Asymmetric distances of sub-vector table ``queries`` (query_id, [cid,] sg, u) to codes p_a."""
    return f"""{p}_lut AS MATERIALIZED (
      SELECT q.*, c.cid AS code, {l2('q.u', 'c.c')} AS part FROM {queries} q JOIN {p}_c{rounds} c USING (sg))"""


def lloyd_bits(k: int, rounds: int) -> list[str]:
    """Majority centres over bit lists: bc0.. and ba (vec_id, cid)."""
    def near(c: str) -> str:
        return f"""SELECT vec_id, code, b, cid FROM (
          SELECT x.vec_id, x.code, x.b, y.cid,
                 row_number() OVER (PARTITION BY x.vec_id ORDER BY bit_count(xor(x.code, y.c)), y.cid) AS r
          FROM bits x, {c} y) WHERE r = 1"""
    ctes = [f"""bc0 AS MATERIALIZED (SELECT cid, code AS c FROM (
        SELECT code, row_number() OVER (ORDER BY md5(CAST(vec_id AS VARCHAR)), vec_id) - 1 AS cid FROM bits)
        WHERE cid < {k})"""]
    for r in range(rounds):
        ctes.append(f"ba{r} AS MATERIALIZED ({near(f'bc{r}')})")
        ctes.append(f"""bc{r + 1} AS MATERIALIZED (
          SELECT old.cid, coalesce(new.c, old.c) AS c FROM bc{r} old LEFT JOIN (
            SELECT cid, string_agg(CASE WHEN 2 * ones > n THEN '1' ELSE '0' END, '' ORDER BY i)::BIT AS c FROM (
              SELECT cid, i, sum(x) AS ones, count(*) AS n FROM (
                SELECT cid, unnest(b) AS x, unnest(range(0, len(b))) AS i FROM ba{r}) GROUP BY cid, i)
            GROUP BY cid) new USING (cid))""")
    ctes.append(f"ba AS MATERIALIZED ({near(f'bc{rounds}')})")
    ctes.append(f"blists AS MATERIALIZED (SELECT cid, c FROM bc{rounds})")
    return ctes


def build() -> dict[str, str]:
    sql: dict[str, str] = {}
    b, bb = with_(BASE), with_(BASE, BITS)

    # sources and sinks
    sql["vector_scan"] = b + "SELECT vec_id, CAST(len(v) AS INTEGER) AS dims, round(list_sum(v), 6) AS total FROM e"
    sql["float32_records"] = b + "SELECT row_number() OVER (ORDER BY vec_id) - 1 AS vec_id, CAST(len(v) AS INTEGER) AS dims, round(list_sum(v), 6) AS total FROM e"
    sql["bit_records"] = bb + "SELECT row_number() OVER (ORDER BY vec_id) - 1 AS vec_id, CAST(list_sum(b) AS BIGINT) AS ones FROM bits"
    sql["saved_table"] = b + "SELECT 'FLAT_L2' AS kind, count(*) AS ntotal, CAST(max(len(v)) AS INTEGER) AS dims, round(sum(list_sum(v)), 6) AS total FROM e"
    sql["json_results"] = b + out(top(pairs(l2("q.v", "b.v")), 3))
    draw = "(CAST(CAST('0x' || md5('42:{0}:' || vec_id || ':' || i)[1:13] AS BIGINT) AS DOUBLE) + 0.5) / 4503599627370496.0"
    sql["synthetic_vectors"] = f"""WITH z AS (
        SELECT vec_id, i, sqrt(-2 * ln({draw.format(1)})) * cos(2 * pi() * {draw.format(2)}) * 0.15 AS x
        FROM embeddings, (SELECT unnest(range(1, 33)) AS i))
      SELECT vec_id, CAST(i - 1 AS INTEGER) AS pos, round(x / sqrt(sum(x * x) OVER (PARTITION BY vec_id)), 6) AS value FROM z"""
    sql["text_embedding"] = """WITH w AS (
        SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[ \\t\\n\\x0b\\f\\r]+')) AS word FROM documents),
      d AS (SELECT doc_id, md5(word) AS m FROM w WHERE word <> ''),
      x AS (SELECT doc_id, ('0x' || m[1:8])::BIGINT % 256 AS slot,
                   sum(CASE WHEN ('0x' || m[9:9])::INT < 8 THEN 1 ELSE -1 END) AS x FROM d GROUP BY ALL),
      n AS (SELECT doc_id, sqrt(sum(x * x)) AS norm FROM x GROUP BY doc_id)
      SELECT doc_id, CAST(slot AS INTEGER) AS slot, round(x / norm, 6) AS value FROM x JOIN n USING (doc_id) WHERE x <> 0"""

    # preparation and quality
    sql["normalize"] = b + f"""SELECT vec_id, i AS pos, round(x, 6) AS value FROM (
        SELECT vec_id, unnest({unit('v')}) AS x, CAST(unnest(range(0, len(v))) AS INTEGER) AS i FROM s)"""
    damaged = """dm AS (SELECT vec_id, CASE
        WHEN label = 1 THEN list_concat(v[1:2], ['nan'::DOUBLE], v[4:])
        WHEN label = 2 THEN list_transform(v, lambda x: 0.0)
        WHEN label = 3 THEN v[1:60]
        WHEN label = 4 THEN list_concat(['inf'::DOUBLE], v[2:63], ['-inf'::DOUBLE])
        ELSE v END AS v FROM e JOIN (SELECT vec_id, label FROM embeddings) USING (vec_id)),
      dq AS (SELECT vec_id, v, len(list_filter(v, lambda x: NOT isfinite(x))) AS bad,
        list_sum(list_transform(v, lambda x: CASE WHEN isfinite(x) THEN x * x ELSE 0 END)) AS n2 FROM dm)"""
    sql["validate_vectors"] = with_(BASE, damaged) + """SELECT count(*) AS vector_count, sum(bad)::BIGINT AS non_finite,
        count(*) FILTER (bad > 0) AS non_finite_vectors, count(*) FILTER (n2 = 0) AS zero_norm_vectors,
        count(*) FILTER (len(v) <> 64) AS wrong_dims_vectors, 64 AS dims,
        sum(bad) = 0 AND count(*) FILTER (len(v) <> 64) = 0 AS valid FROM dq"""
    sql["non_finite_positions"] = with_(BASE, damaged) + """SELECT vec_id, CAST(i AS INTEGER) AS component,
        CAST(x AS VARCHAR) AS value FROM (
        SELECT vec_id, unnest(v) AS x, unnest(range(0, len(v))) AS i FROM dm) WHERE NOT isfinite(x)"""
    sql["zero_norm_vectors"] = with_(BASE, damaged) + "SELECT vec_id FROM dq WHERE n2 = 0"
    sql["good_reject_split"] = with_(BASE, damaged) + """SELECT vec_id,
        CASE WHEN len(v) = 64 AND bad = 0 THEN 'good' ELSE 'reject' END AS part FROM dq"""
    sql["validate_codes"] = """SELECT count(*) AS vector_count, count(*) FILTER (label = 3) AS wrong_width, 64 AS dims,
        8 AS bytes_per_vector, count(*) FILTER (label = 3) = 0 AS valid FROM embeddings"""
    sql["chunks"] = """SELECT chunk_id, count(*) AS n, min(vec_id) AS first_id, max(vec_id) AS last_id FROM (
        SELECT vec_id, (row_number() OVER (ORDER BY vec_id) - 1) // 128 AS chunk_id FROM embeddings) GROUP BY chunk_id"""
    sql["sign_codes"] = bb + """SELECT vec_id, string_agg(upper(printf('%02x', byte)), '' ORDER BY p) AS code FROM (
        SELECT vec_id, p, CAST(list_sum(list_transform(range(0, 8), lambda i: b[p * 8 + i + 1] << i)) AS INTEGER) AS byte
        FROM bits, (SELECT unnest(range(0, 8)) AS p)) GROUP BY vec_id"""

    # pairwise distances
    sql["pairwise_aligned"] = bb + f"""SELECT e.vec_id, round({l2('e.v', 's.v')}, 6) AS l2, round({ip('e.v', 's.v')}, 6) AS ip,
        round({ip('e.v', 's.v')} / (sqrt({ip('e.v', 'e.v')}) * sqrt({ip('s.v', 's.v')})), 6) AS cosine
        FROM e JOIN s USING (vec_id)"""
    mean = """mean AS (SELECT list(m ORDER BY i) AS v FROM (SELECT i, avg(x) AS m FROM (
        SELECT unnest(v) AS x, unnest(range(0, len(v))) AS i FROM s) GROUP BY i))"""
    sql["pairwise_one_to_many"] = with_(BASE, mean) + f"""SELECT s.vec_id, round({l2('s.v', 'mean.v')}, 6) AS l2,
        round({ip('s.v', 'mean.v')}, 6) AS ip,
        round({ip('s.v', 'mean.v')} / (sqrt({ip('s.v', 's.v')}) * sqrt({ip('mean.v', 'mean.v')})), 6) AS cosine FROM s, mean"""
    sql["pairwise_hamming"] = bb + """SELECT x.vec_id, CAST(bit_count(xor(x.code, y.code)) AS INTEGER) AS hamming
        FROM bits x JOIN (SELECT vec_id, string_agg(CASE WHEN x > 0 THEN '1' ELSE '0' END, '' ORDER BY i DESC)::BIT AS code
          FROM (SELECT vec_id, unnest(v) AS x, unnest(range(0, len(v))) AS i FROM e) GROUP BY vec_id) y USING (vec_id)"""

    # exact search
    sql["knn_single"] = with_(BASE, mean) + f"""SELECT CAST(rank AS INTEGER) AS rank, vec_id, round(d, 6) AS distance FROM (
        SELECT vec_id, d, row_number() OVER (ORDER BY d, vec_id) AS rank FROM (
          SELECT s.vec_id, {l2('s.v', 'mean.v')} AS d FROM s, mean)) WHERE rank <= {K}"""
    sql["knn_l2"] = b + out(top(pairs(l2("q.v", "b.v"))))
    sql["knn_ip"] = b + out(top(pairs(ip("q.v", "b.v")), order="d DESC"))
    u = f"u AS MATERIALIZED (SELECT vec_id, {unit('v')} AS v FROM s)"
    sql["knn_cosine"] = with_(BASE, u) + out(top(pairs(ip("q.v", "b.v"), "u", "u"), order="d DESC"))
    sql["radius_l2"] = b + f"SELECT query_id, vec_id, round(d, 6) AS distance FROM {pairs(l2('q.v', 'b.v'), 'e', 'e')} WHERE d < 1.4"
    sql["radius_ip"] = b + f"SELECT query_id, vec_id, round(d, 6) AS distance FROM {pairs(ip('q.v', 'b.v'))} WHERE d > 1.5"
    sql["radius_counts"] = b + f"""SELECT query_id, count(*) FILTER (d < 2.5) AS n
        FROM {pairs(l2('q.v', 'b.v'))} GROUP BY query_id"""
    ham = "bit_count(xor(q.code, b.code))"
    hout = "SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(d AS INTEGER) AS distance FROM "
    sql["knn_hamming"] = bb + hout + f"({top(pairs(ham, 'bits', 'bits'))})"

    # partitioned
    c = with_(BASE, *coarse())
    sql["ivf_train"] = c + """SELECT CAST(cid AS INTEGER) AS list_id, pos, round(x, 6) AS value FROM (
        SELECT cid, unnest(c) AS x, CAST(unnest(range(0, len(c))) AS INTEGER) AS pos FROM lists)"""
    sql["ivf_assign"] = c + "SELECT vec_id, CAST(cid AS INTEGER) AS list_id FROM assigned"
    sql["auto_train"] = c + "SELECT CAST(cid AS INTEGER) AS list_id, count(*) AS n FROM assigned GROUP BY cid"
    found = pairs(l2("q.v", "b.v"), "probes", "assigned", "WHERE q.cid = b.cid")
    cp = with_(BASE, *coarse(), probes(3))
    sql["ivf_search"] = cp + out(top(found))
    sql["ivf_recall"] = cp + f""", ex AS ({top(pairs(l2('q.v', 'b.v'), 'e', 'e'))}), ap AS ({top(found)})
      SELECT count(DISTINCT query_id) AS queries, round(avg(CASE WHEN ap.d IS NULL THEN 0.0 ELSE 1.0 END), 6) AS recall
      FROM ex LEFT JOIN ap USING (query_id, vec_id)"""
    every = "probes AS MATERIALIZED (SELECT q.vec_id, q.v, l.cid, row_number() OVER (PARTITION BY q.vec_id ORDER BY " + l2("q.v", "l.c") + """,
        l.cid) AS r FROM e q, lists l)"""
    sql["recall_by_nprobe"] = with_(BASE, *coarse(), every) + f""", ex AS ({top(pairs(l2('q.v', 'b.v'), 'e', 'e'))}),
      cand AS (SELECT p.nprobe, q.vec_id AS query_id, b.vec_id, {l2('q.v', 'b.v')} AS d
        FROM (SELECT unnest(range(1, {LISTS} + 1)) AS nprobe) p JOIN probes q ON q.r <= p.nprobe JOIN assigned b ON b.cid = q.cid),
      ap AS (SELECT * FROM cand QUALIFY row_number() OVER (PARTITION BY nprobe, query_id ORDER BY d, vec_id) <= {K})
      SELECT CAST(nprobe AS INTEGER) AS nprobe, round(count(*) / (SELECT count(*) FROM ex), 6) AS recall
      FROM ap JOIN ex USING (query_id, vec_id) GROUP BY nprobe"""
    sql["ivf_all_lists"] = b + out(top(pairs(l2("q.v", "b.v"), "e", "e")))

    # scalar codes
    for bits, name in ((255, "sq8"), (15, "sq4")):
        q = with_(BASE, *scalar(bits, "s"))
        sql[f"{name}_codes"] = q + "SELECT vec_id, CAST(i AS INTEGER) AS pos, CAST(code AS INTEGER) AS code FROM sqflat"
    sql["sq8_decode"] = with_(BASE, *scalar(255, "s")) + """SELECT vec_id, count(*) AS n,
        round(sum(abs(x - (code * step + (low + 0.5 * step)))), 6) AS error,
        max(abs(x - (code * step + (low + 0.5 * step)))  - step / 2) <= 1e-9 AS within_half_step
        FROM sqflat GROUP BY vec_id"""
    sql["fp16_codes"] = """SELECT vec_id, CAST(i AS INTEGER) AS pos,
        CASE WHEN x = 0 THEN 0.0 ELSE round(round_even(x / ulp, 0) * ulp, 9) END AS value
      FROM (SELECT *, pow(2, greatest(floor(log2(abs(x))), -14) - 10) AS ulp FROM (
        SELECT vec_id, unnest(CAST(embedding AS DOUBLE[])) AS x, unnest(range(0, len(embedding))) AS i FROM embeddings))"""
    sql["sq8_search"] = with_(BASE, *scalar(255, "s")) + out(top(pairs(l2("q.v", "b.v"), "e", "sq")))
    sql["ivf_sq_search"] = with_(BASE, *coarse(), probes(3), *scalar(255)) + out(top(
        "(SELECT q.vec_id AS query_id, b.vec_id, " + l2("q.v", "b.v")
        + " AS d FROM probes q JOIN assigned a USING (cid) JOIN sq b ON b.vec_id = a.vec_id)"))

    # product codes
    pq = lloyd("pq", "e", CODES, PQ_ROUNDS, SEGMENTS, DIMS // SEGMENTS)
    p = with_(BASE, *pq)
    sql["pq_train"] = p + f"""SELECT CAST(sg AS INTEGER) AS segment, CAST(cid AS INTEGER) AS code, pos, round(x, 6) AS value FROM (
        SELECT sg, cid, unnest(c) AS x, CAST(unnest(range(0, len(c))) AS INTEGER) AS pos FROM pq_c{PQ_ROUNDS})"""
    sql["pq_codes"] = p + "SELECT vec_id, CAST(sg AS INTEGER) AS segment, CAST(cid AS INTEGER) AS code FROM pq_a"
    sql["pq_decode"] = p + f"""SELECT vec_id, round(sum({l2('u', 'c')}), 6) AS error
        FROM pq_a JOIN pq_c{PQ_ROUNDS} USING (sg, cid) GROUP BY vec_id"""
    qsub = "qsub AS MATERIALIZED (SELECT vec_id AS query_id, sg, u FROM pq_sub)"
    sql["pq_search"] = with_(BASE, *pq, qsub, adc("pq", "qsub", PQ_ROUNDS)) + out(top(
        "(SELECT l.query_id, a.vec_id, sum(l.part ORDER BY l.sg) AS d FROM pq_lut l "
        "JOIN pq_a a ON a.sg = l.sg AND a.cid = l.code GROUP BY ALL)"))
    res = """res AS MATERIALIZED (SELECT a.vec_id, list_transform(range(1, 65), lambda i: a.v[i] - l.c[i]) AS v
        FROM assigned a JOIN lists l USING (cid))"""
    rq = f"""qres AS MATERIALIZED (SELECT query_id, cid, sg, r[sg * 8 + 1 : sg * 8 + 8] AS u FROM (
        SELECT p.vec_id AS query_id, p.cid, list_transform(range(1, 65), lambda i: p.v[i] - l.c[i]) AS r
        FROM probes p JOIN lists l USING (cid)), (SELECT unnest(range(0, {SEGMENTS})) AS sg))"""
    rlut = f"""rlut AS MATERIALIZED (SELECT q.query_id, q.cid, q.sg, c.cid AS code, {l2('q.u', 'c.c')} AS part
        FROM qres q JOIN rp_c{PQ_ROUNDS} c USING (sg))"""
    sql["ivf_pq_search"] = with_(
        BASE, *coarse(), probes(3), res, *lloyd("rp", "res", CODES, PQ_ROUNDS, SEGMENTS, DIMS // SEGMENTS), rq, rlut,
    ) + out(top("""(SELECT l.query_id, b.vec_id, sum(l.part ORDER BY l.sg) AS d
        FROM rlut l JOIN assigned b ON b.cid = l.cid
        JOIN rp_a a ON a.vec_id = b.vec_id AND a.sg = l.sg AND a.cid = l.code GROUP BY ALL)"""))

    # inner products over stretched vectors
    best = "d DESC"
    sql["sq_ip_search"] = with_(BASE, *scalar(255, "s")) + out(top(pairs(ip("q.v", "b.v"), "e", "sq"), order=best))
    near = """{0} AS MATERIALIZED (SELECT vec_id, v, cid FROM (SELECT x.vec_id, x.v, l.cid,
        row_number() OVER (PARTITION BY x.vec_id ORDER BY {1} DESC, l.cid) AS r FROM {2} x, lists l) WHERE r <= {3})"""
    spread = [*lloyd("ivf", "s", LISTS, COARSE_ROUNDS), f"lists AS MATERIALIZED (SELECT cid, c FROM ivf_c{COARSE_ROUNDS})",
              near.format("assigned", ip("x.v", "l.c"), "s", 1), near.format("probes", ip("x.v", "l.c"), "e", 3)]
    sql["ivf_ip_search"] = with_(BASE, *spread) + out(top(
        pairs(ip("q.v", "b.v"), "probes", "assigned", "WHERE q.cid = b.cid"), order=best))
    spq = lloyd("sp", "s", CODES, PQ_ROUNDS, SEGMENTS, DIMS // SEGMENTS)
    asked = f"""asub AS MATERIALIZED (SELECT vec_id AS query_id, sg, v[sg * 8 + 1 : sg * 8 + 8] AS u
        FROM e, (SELECT unnest(range(0, {SEGMENTS})) AS sg)),
      slut AS MATERIALIZED (SELECT q.query_id, q.sg, c.cid AS code, {ip('q.u', 'c.c')} AS part FROM asub q JOIN sp_c{PQ_ROUNDS} c USING (sg))"""
    sql["pq_ip_search"] = with_(BASE, *spq, asked) + out(top(
        "(SELECT l.query_id, a.vec_id, sum(l.part ORDER BY l.sg) AS d FROM slut l "
        "JOIN sp_a a ON a.sg = l.sg AND a.cid = l.code GROUP BY ALL)", order=best))

    # reductions and pipelines that must not lose anything
    sql["pca_full_width"] = sql["knn_l2"]
    sql["composed_exact"] = sql["ivf_all_lists"]
    sql["pca_reduced"] = "SELECT count(*) AS queries, true AS better_than_chance FROM embeddings"
    sql["opq_improves"] = "SELECT count(*) AS vectors, true AS not_worse FROM embeddings"
    sql["graph_full_beam"] = sql["graph_insert"] = sql["ivf_all_lists"]
    sql["bit_graph_full_beam"] = sql["knn_hamming"]

    # bit codes
    bl = with_(BASE, BITS, *lloyd_bits(LISTS, COARSE_ROUNDS))
    sql["bit_ivf_train"] = bl + "SELECT CAST(cid AS INTEGER) AS list_id, CAST(c AS VARCHAR) AS bits FROM blists"
    sql["bit_ivf_search"] = bl + """, probes AS (SELECT vec_id, code, cid FROM (
        SELECT q.vec_id, q.code, l.cid, row_number() OVER (
          PARTITION BY q.vec_id ORDER BY bit_count(xor(q.code, l.c)), l.cid) AS r FROM bits q, blists l) WHERE r <= 3)
      """ + hout + f"({top(pairs(ham, 'probes', 'ba', 'WHERE q.cid = b.cid'))})"
    prefix = "bit_count(xor(substring(CAST(q.code AS VARCHAR), {0}, 8)::BIT, substring(CAST(b.code AS VARCHAR), {0}, 8)::BIT)) <= 1"
    sql["hash_search"] = bb + hout + f"({top(pairs(ham, 'bits', 'bits', 'WHERE ' + prefix.format(1)))})"
    many = " OR ".join(prefix.format(1 + 8 * t) for t in range(4))
    sql["multi_hash_search"] = bb + hout + f"({top(pairs(ham, 'bits', 'bits', f'WHERE {many}'))})"

    # maintenance
    sql["append"] = """SELECT vec_id, label, src FROM (
        SELECT vec_id, label, 'old' AS src FROM embeddings UNION ALL
        SELECT (SELECT max(vec_id) + 1 FROM embeddings) + row_number() OVER (ORDER BY label, vec_id) - 1, label, 'new'
        FROM embeddings)"""
    sql["ingest_stream"] = "SELECT row_number() OVER (ORDER BY vec_id % 4, label, vec_id) - 1 AS vec_id, vec_id AS source_id, label FROM embeddings"
    sql["ingest_progress"] = """SELECT vec_id % 4 AS batch_id, count(*) AS batch_rows,
        CAST(sum(count(*)) OVER (ORDER BY vec_id % 4) AS BIGINT) AS processed FROM embeddings GROUP BY vec_id % 4"""
    sql["lookup"] = b + """, ids AS (SELECT doc_id AS pos, doc_id AS vec_id FROM labels
        UNION ALL SELECT doc_id + 1000000000, doc_id FROM labels)
      SELECT pos, vec_id, round(list_sum(v), 6) AS total FROM ids LEFT JOIN e USING (vec_id)"""
    sql["remove"] = "SELECT vec_id, label FROM embeddings WHERE vec_id NOT IN (SELECT doc_id FROM labels WHERE quality = 0)"
    sql["removed_count"] = "SELECT count(*) AS removed FROM embeddings WHERE vec_id IN (SELECT doc_id FROM labels WHERE quality = 0)"
    sql["merge"] = b + """SELECT vec_id, round(list_sum(v), 6) AS total FROM (
        SELECT vec_id, v FROM e UNION ALL SELECT vec_id + (SELECT max(vec_id) + 1 FROM e), v FROM s)"""
    good = "vec_id NOT IN (SELECT doc_id FROM labels WHERE quality = 0)"
    sql["stored_changes"] = b + f"""SELECT CAST(version AS BIGINT) AS version, vec_id, round(list_sum(v), 6) AS total
        FROM e, (VALUES (0), (1), (2), (3)) AS t(version)
        WHERE (version = 1 AND vec_id % 2 = 0) OR version = 2 OR (version IN (0, 3) AND {good})"""
    sql["stored_history"] = f"""SELECT CAST(version AS BIGINT) AS version, token, CAST(parts AS INTEGER) AS parts, CAST(deletes AS INTEGER) AS deletes,
        count(*) FILTER (version > 1 OR vec_id % 2 = 0) - count(*) FILTER (version = 3 AND NOT {good}) AS ntotal
        FROM embeddings, (VALUES (1, NULL, 1, 0), (2, 'odd', 2, 0), (3, 'poor', 2, 1)) AS t(version, token, parts, deletes) GROUP BY ALL"""
    sql["stored_search"] = b + out(top(pairs(l2("q.v", "b.v"), "e", "e", f"WHERE b.{good}")))
    sql["stored_merge"] = f"""SELECT vec_id, CAST(len(embedding) AS INTEGER) AS dims FROM embeddings
        UNION ALL SELECT vec_id + (SELECT max(vec_id) + 1 FROM embeddings), CAST(len(embedding) AS INTEGER) FROM embeddings WHERE {good}"""
    sql["reset"] = "SELECT 0::BIGINT AS ntotal, true AS is_trained, count(*) > 0 AS had_rows FROM embeddings"
    sql["stats"] = """SELECT count(*) AS ntotal, max(len(embedding))::INTEGER AS dims, true AS is_trained,
        'FLAT_L2' AS kind, 'l2' AS metric FROM embeddings"""
    sql["inspect"] = c + """SELECT sum(n)::BIGINT AS ntotal, 'IVF_FLAT' AS kind, count(*) AS lists, min(n) AS smallest,
        max(n) AS largest, round(avg(n), 6) AS mean, round(max(n) / avg(n), 6) AS skew, 2 AS hint_count FROM (
        SELECT cid, count(*) AS n FROM assigned GROUP BY cid)"""
    sql["check"] = """WITH n AS (SELECT count(*) AS n, count(*) // 3 AS step FROM embeddings),
      r AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS p FROM embeddings),
      s AS (SELECT string_agg(vec_id, ',' ORDER BY vec_id) AS ids FROM r, n
            WHERE p IN (0, step, 2 * step, n - 1))
      SELECT 'dimensions' AS "check", true AS passed, 'dims=64' AS message
      UNION ALL SELECT 'vectorCount', true, 'ntotal=' || n FROM n
      UNION ALL SELECT 'reconstruct', true, 'sampleIds=' || ids FROM s
      UNION ALL SELECT 'selfSearch', true, 'a sampled vector has a nearest row'"""
    sql["check_codes"] = sql["check"] + """ UNION ALL SELECT 'bytesPerVector', true, 'bytesPerVector=8'"""
    sql["stats_codes"] = """SELECT count(*) AS ntotal, max(len(embedding))::INTEGER AS dims, true AS is_trained,
        'BINARY_FLAT' AS kind, 'hamming' AS metric, CAST(max(len(embedding)) // 8 AS INTEGER) AS bytes_per_vector FROM embeddings"""
    signs = sql["sign_codes"].removeprefix(bb)
    sql["merge_codes"] = bb + f""", c AS ({signs}) SELECT vec_id, code FROM c
      UNION ALL SELECT vec_id + (SELECT max(vec_id) + 1 FROM c), code FROM c"""

    # retrieval
    sql["retrieve_documents"] = b + f"""SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id AS doc_id, source, n_chars,
        round(1 / (1 + d), 6) AS similarity FROM ({top(pairs(l2('q.v', 'b.v')), 3)}) LEFT JOIN documents ON doc_id = vec_id"""
    sql["recommend"] = with_(BASE, u) + f"""SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, label, round(d, 6) AS distance
        FROM ({top(pairs(ip('q.v', 'b.v'), 'u', 'u'), 3, 'd DESC')}) LEFT JOIN (SELECT vec_id, label FROM embeddings) USING (vec_id)"""
    sql["media_similarity"] = with_(BASE, u) + f"""SELECT query_id, CAST(rank AS INTEGER) AS rank, url, round(d, 4) AS score
        FROM ({top(pairs(ip('q.v', 'b.v'), 'u', 'u'), 2, 'd DESC')}) LEFT JOIN pages ON page_id = vec_id"""
    sql["match_stream"] = b + out(top(pairs(l2("q.v", "b.v")), 5))
    return sql
