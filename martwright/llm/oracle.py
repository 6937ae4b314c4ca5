"""DuckDB SQL of the queries that SQL can express."""



def _centroids(rounds: int = 3) -> str:
    """Each round is a table of the centroids after it."""
    steps = []
    for i in range(rounds + 1):
        steps.append(
            f"""
        d{i} AS (
            SELECT kept.row, c.cluster, CAST(sum((v - c.x) * (v - c.x)) AS BIGINT) AS distance
            FROM (SELECT row, unnest(vector) AS v, unnest(range(1, 65)) AS place FROM kept) kept
            JOIN c{i} c USING (place) GROUP BY ALL
        ), a{i} AS (
            SELECT row, arg_min(cluster, (distance, cluster)) AS cluster, min(distance) AS distance
            FROM d{i} GROUP BY row
        )"""
        )
        if i < rounds:
            steps.append(
                f"""
        m{i} AS (
            SELECT cluster, place, CAST(floor_sum AS BIGINT) AS x FROM (
                SELECT cluster, place, (sum(v) - ((sum(v) % count(*)) + count(*)) % count(*)) // count(*) AS floor_sum
                FROM (SELECT row, unnest(vector) AS v, unnest(range(1, 65)) AS place FROM kept)
                JOIN a{i} USING (row) GROUP BY ALL)
        ), c{i + 1} AS (
            SELECT cluster, place, coalesce(m{i}.x, c{i}.x) AS x FROM c{i} LEFT JOIN m{i} USING (cluster, place)
        )"""
            )
    return f"""
        WITH kept AS (
            SELECT row_number() OVER () AS row, vec_id,
                   list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS vector
            FROM embeddings
            WHERE len(embedding) = 64
              AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
        ), first AS (
            SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), vector) - 1 AS cluster, vector
            FROM kept WHERE vec_id IS NOT NULL
            QUALIFY cluster < 16
        ), c0 AS (
            SELECT CAST(cluster AS INTEGER) AS cluster, unnest(range(1, 65)) AS place, unnest(vector) AS x FROM first
        ),{",".join(steps)}, names AS (
            SELECT cluster, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY place)) AS centroid_sha256
            FROM c{rounds} GROUP BY cluster
        )
        SELECT vec_id, cluster, distance,
               CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
               CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256
        FROM a{rounds} JOIN kept USING (row) JOIN names USING (cluster)
    """


ORACLES = {
    "op2_exact_dedup": r"""
        WITH plain AS (
            SELECT doc_id, coalesce(text, '') AS text,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS kept_text
            FROM documents
        ), chosen AS (
            SELECT doc_id, kept_text,
                   first_value(doc_id) OVER (
                       PARTITION BY kept_text ORDER BY length(text) DESC, doc_id
                   ) AS keep_id,
                   count(*) OVER (PARTITION BY kept_text) AS group_size
            FROM plain
        )
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept,
               sha256(kept_text) AS text_sha256
        FROM chosen
    """,
    "op3_minhash": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, regexp_extract_all(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x20\x09-\x0D]+') AS w
            FROM documents
        ), shingles AS (
            SELECT DISTINCT doc_id, unnest(
                       CASE WHEN len(w) = 0 THEN []
                            WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                            ELSE list_transform(range(1, len(w) - 1),
                                                lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])
                       END) AS shingle
            FROM words
        ), sizes AS (
            SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
        ), pairs AS (
            SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common
            FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
            GROUP BY ALL
        ), links AS (
            SELECT x, y FROM pairs JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
            WHERE 100 * common >= 85 * (p.n + q.n - common)
        ), reach(doc_id, other) AS (
            SELECT doc_id, doc_id FROM documents
            UNION
            SELECT reach.doc_id, links.y FROM reach JOIN links ON links.x = reach.other
        )
        SELECT doc_id, coalesce(n, 0) AS n_shingles, min(other) AS component_id,
               doc_id = min(other) AS kept
        FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY doc_id, n
    """,
    "op9_line_dedup": r"""
        WITH split AS (
            SELECT doc_id, text, string_split(text, chr(10)) AS parts FROM documents
        ), lines AS (
            SELECT doc_id, unnest(range(len(parts))) AS no, unnest(parts) AS line FROM split
        ), parsed AS (
            SELECT doc_id, no, list_transform(
                       list_filter(string_split_regex(line, '[\x20\x09\x0B-\x0D]+'), lambda t: t <> ''),
                       lambda t: CASE WHEN regexp_matches(t, '[0-9]') THEN '<*>' ELSE t END) AS tokens
            FROM lines
        ), placed AS (
            SELECT doc_id, no, tokens,
                   len(tokens) || ' ' || array_to_string(tokens[1:3], ' ') AS leaf
            FROM parsed WHERE len(tokens) > 0
        ), busy AS (
            SELECT leaf FROM placed GROUP BY leaf HAVING count(DISTINCT doc_id) >= 10
        ), different AS (
            SELECT leaf, tokens, count(DISTINCT doc_id) AS documents
            FROM placed JOIN busy USING (leaf) GROUP BY ALL
        ), fields AS (
            SELECT leaf, tokens, documents, unnest(range(4, len(tokens) + 1)) AS place,
                   unnest(tokens[4:]) AS token
            FROM different
        ), constant AS (
            SELECT leaf, place, token FROM fields GROUP BY ALL HAVING sum(documents) >= 10
        ), kept AS (
            SELECT leaf, tokens, count(*) AS n, count(*) FILTER (token <> '<*>') AS n_words,
                   string_agg(place || ' ' || token, chr(10) ORDER BY place) AS template
            FROM fields JOIN constant USING (leaf, place, token) GROUP BY ALL
        ), templates AS (
            -- Leading fields with a digit are not constant, and half of all places are constant words.
            SELECT leaf, tokens, coalesce(template, '') AS template
            FROM different LEFT JOIN kept USING (leaf, tokens)
            WHERE coalesce(n, 0) + len(list_filter(tokens[1:3], lambda t: t <> '<*>'))
                  >= CAST(0.7 AS DOUBLE) * len(tokens)
              AND coalesce(n_words, 0) + len(list_filter(tokens[1:3], lambda t: t <> '<*>'))
                  >= CAST(0.5 AS DOUBLE) * len(tokens)
        ), matched AS (
            SELECT doc_id, no, leaf, template FROM placed JOIN templates USING (leaf, tokens)
        ), recurring AS (
            SELECT leaf, template, min((doc_id, no)) AS first
            FROM matched GROUP BY ALL HAVING count(DISTINCT doc_id) >= 10
        ), dropped AS (
            SELECT doc_id, no FROM matched JOIN recurring USING (leaf, template)
            WHERE (doc_id, no) <> first
        ), losing AS (
            SELECT doc_id, count(*) AS n_dropped FROM dropped GROUP BY doc_id
        ), rebuilt AS (
            SELECT doc_id, string_agg(line, chr(10) ORDER BY no) AS shorter
            FROM lines ANTI JOIN dropped USING (doc_id, no) SEMI JOIN losing USING (doc_id)
            GROUP BY doc_id
        ), result AS (
            SELECT doc_id, coalesce(n_dropped, 0) AS n_dropped,
                   CASE WHEN n_dropped IS NULL THEN text ELSE coalesce(shorter, '') END AS left_over
            FROM documents LEFT JOIN losing USING (doc_id) LEFT JOIN rebuilt USING (doc_id)
        )
        SELECT doc_id, CAST(n_dropped AS INTEGER) AS n_dropped,
               CAST(length(left_over) AS INTEGER) AS points_left, md5(left_over) AS text_md5
        FROM result
    """,
    "op11_spelling": r"""
        WITH RECURSIVE bits AS (
            -- The table of the CRC-32 of one byte, from its polynomial.
            SELECT list_transform(range(256), lambda b: list_reduce(
                       range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END,
                       CAST(b AS BIGINT))) AS t
        ), runs AS (
            SELECT doc_id, unnest(regexp_extract_all(
                       translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run
            FROM documents
        ), counted AS (
            SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 6 GROUP BY ALL
        ), hexed AS (
            SELECT doc_id, run, n, hex(encode(doc_id || ':' || run)) AS h FROM counted
        ), marked AS (
            SELECT run, n, xor(list_reduce(
                       list_transform(range(CAST(length(h) / 2 AS BIGINT)), lambda i:
                           16 * (instr('0123456789ABCDEF', h[2 * i + 1]) - 1)
                           + instr('0123456789ABCDEF', h[2 * i + 2]) - 1),
                       lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]),
                       CAST(4294967295 AS BIGINT)), 4294967295) AS mark
            FROM hexed, bits
        ), spelt AS (
            SELECT CASE WHEN mark % 199 = 0
                        THEN left(run, mark % length(run)) || substr(run, mark % length(run) + 2)
                        ELSE run END AS word, n
            FROM marked
        ), words AS (
            SELECT word, CAST(sum(n) AS BIGINT) AS n FROM spelt
            WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
        ), holes AS (
            SELECT word, n, unnest(range(1, length(word) + 1)) AS hole FROM words
        ), cut AS (
            SELECT word, n, hole, left(word, hole - 1) AS a, substr(word, hole + 1) AS b FROM holes
        ), near AS (
            SELECT x.word, y.word AS other, y.n AS other_n
            FROM cut x JOIN cut y ON x.a = y.a AND x.b = y.b AND x.hole = y.hole AND x.word <> y.word
            UNION
            SELECT x.word, y.word, y.n FROM cut x JOIN words y ON y.word = x.a || x.b
            UNION
            SELECT y.word, x.word, x.n FROM cut x JOIN words y ON y.word = x.a || x.b
        ), best AS (
            SELECT word, count(*) AS n_near, max(other_n) AS best_n,
                   arg_min(other, (-other_n, other)) AS best
            FROM near GROUP BY word
        ), formed AS (
            SELECT word, n, coalesce(n_near, 0) AS n_near,
                   CASE WHEN best_n >= 5 * n THEN best END AS form,
                   CASE WHEN best_n >= 5 * n THEN best_n END AS form_n
            FROM words LEFT JOIN best USING (word)
        ), climb AS (
            SELECT word, word AS root FROM formed WHERE form IS NULL
            UNION ALL
            SELECT formed.word, climb.root FROM formed JOIN climb ON formed.form = climb.word
        )
        SELECT word, n, n_near, form, form_n, root FROM formed JOIN climb USING (word)
    """,
    "op13_centroids": _centroids(),
}
