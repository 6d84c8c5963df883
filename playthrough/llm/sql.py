"""SQL whose rows equal those of registered queries."""

SQL: dict[str, str] = {}

SQL["op9_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

SQL["op10_mixing"] = r"""
WITH sized AS (
    SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
    FROM documents
), sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
           [3, 1, 2][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
    FROM sized GROUP BY source
), filled AS (
    SELECT *, 2 * source_size / weight AS reach,
           (1.5 * sum(source_size) OVER () - coalesce(sum(2 * source_size) OVER earlier, 0))
           / (sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0)) AS level
    FROM sources
    WINDOW earlier AS (ORDER BY 2 * source_size / weight, source NULLS LAST
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
    SELECT source, source_size,
           least(CAST(2 * source_size AS DOUBLE),
                 weight * coalesce((SELECT CAST(arg_min(level, reach) FILTER (reach > level) AS DOUBLE) FROM filled), 'inf')) AS target
    FROM filled
)
SELECT doc_id, size, source_size, target,
       CAST(size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM (
    SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
           CAST(CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) AS DOUBLE)
           / 4503599627370496 AS draw
    FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
)
"""

SQL["op7_url_filter"] = r"""
WITH addressed AS (
    SELECT page_id, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
           coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
    FROM pages
), counted AS (
    SELECT host, count(good) AS n, coalesce(sum(good), 0) AS good
    FROM addressed LEFT JOIN (SELECT doc_id AS page_id, min(quality) AS good FROM labels GROUP BY doc_id)
    USING (page_id) GROUP BY host
), hosts AS (
    SELECT *, regexp_extract(domain, '[^.]*$') AS suffix FROM (
        SELECT *, CASE WHEN regexp_matches(name, '^[0-9.]+$') THEN name
                       ELSE regexp_extract(name, '([^.]*\.)?[^.]*$') END AS domain
        FROM (SELECT *, regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') AS name FROM counted))
), suffixes AS (
    SELECT suffix, sum(n) AS n, sum(good) AS good,
           (SELECT (sum(good) + 1) / (sum(n) + 2) FROM hosts) AS prior FROM hosts GROUP BY suffix
), suffix_strength AS (
    SELECT 1 / least(0.999, greatest(0.001, coalesce(
        sum((good - n * prior) ** 2 / n - prior * (1 - prior)) / nullif(sum((n - 1) * prior * (1 - prior)), 0), 0.1))) - 1
        AS m FROM suffixes WHERE n > 0
), domains AS (
    SELECT domain, sum(hosts.n) AS n, sum(hosts.good) AS good,
           any_value((s.good + s.prior * m) / (s.n + m)) AS prior
    FROM hosts JOIN suffixes s USING (suffix), suffix_strength GROUP BY domain
), domain_strength AS (
    SELECT 1 / least(0.999, greatest(0.001, coalesce(
        sum((good - n * prior) ** 2 / n - prior * (1 - prior)) / nullif(sum((n - 1) * prior * (1 - prior)), 0), 0.1))) - 1
        AS m FROM domains WHERE n > 0
), priors AS (
    SELECT host, hosts.n, hosts.good, (d.good + d.prior * m) / (d.n + m) AS prior
    FROM hosts JOIN domains d USING (domain), domain_strength
), host_strength AS (
    SELECT 1 / least(0.999, greatest(0.001, coalesce(
        sum((good - n * prior) ** 2 / n - prior * (1 - prior)) / nullif(sum((n - 1) * prior * (1 - prior)), 0), 0.1))) - 1
        AS m FROM priors WHERE n > 0
), reputation AS (
    SELECT host, mean - 1.645 * sqrt(mean * (1 - mean) / (n + m + 1)) AS bound
    FROM (SELECT host, n, m, (good + prior * m) / (n + m) AS mean FROM priors, host_strength)
), ruled AS (
    SELECT *, CASE
        WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/en/1%' THEN 'example.org/en/1'
        WHEN (host = 'example.org' OR host LIKE '%.example.org') AND path LIKE '/es/%' THEN 'example.org/es/'
        WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/fr/%' THEN 'com/fr/'
        WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/de/%' THEN 'com/de/'
        WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/%' THEN 'org/' END AS rule
    FROM addressed
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN bound >= 0.5 THEN 'allow' ELSE 'block' END AS verdict
FROM ruled JOIN reputation USING (host)
"""


def _centroids_sql(rounds: int = 5, clusters: int = 40) -> str:
    """Every distance anew in every round. All numbers are whole and below 2^53, so that doubles hold them."""
    distance = (
        "list_inner_product(v.u, v.u) - 2 * list_inner_product(v.u, c.u) + list_inner_product(c.u, c.u)"
    )
    steps = [
        f"""WITH v AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS u
    FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
), c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), u) - 1 AS c, u FROM v
    WHERE vec_id IS NOT NULL QUALIFY c < {clusters}
)"""
    ]
    for k in range(rounds + 1):
        steps.append(f"""a{k} AS MATERIALIZED (
    SELECT r, arg_min(c, (d, c)) AS c, min(d) AS d FROM (SELECT v.r, c.c, {distance} AS d FROM v, c{k} c) GROUP BY r
)""")
        if k < rounds:
            steps.append(f"""c{k + 1} AS MATERIALIZED (
    SELECT c.c, coalesce(m.u, c.u) AS u FROM c{k} c LEFT JOIN (
        SELECT c, list(x ORDER BY j) AS u FROM (
            SELECT c, j, floor(sum(x) / count(*)) AS x
            FROM (SELECT a.c, unnest(v.u) AS x, unnest(range(64)) AS j FROM v JOIN a{k} a USING (r)) GROUP BY c, j
        ) GROUP BY c
    ) m USING (c)
)""")
    return ", ".join(steps) + f"""
SELECT v.vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(a.d AS BIGINT) AS distance,
       CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(a.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(list_transform(c.u, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), ',')) AS centroid_sha256
FROM v JOIN a{rounds} a USING (r) JOIN c{rounds} c ON c.c = a.c
"""


SQL["op11_centroid_clustering"] = _centroids_sql()

SQL["op13_spelling_variants"] = r"""
WITH RECURSIVE steps(b, i, c) AS (
    SELECT b, 0, b FROM range(256) AS bytes(b)
    UNION ALL
    SELECT b, i + 1, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END FROM steps WHERE i < 8
), crc AS MATERIALIZED (
    SELECT list(c ORDER BY b) AS t FROM steps WHERE i = 8
), runs AS MATERIALIZED (
    SELECT doc_id, run, count(*) AS times FROM (
        SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS doc_id,
               unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                      'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run
        FROM documents
    ) GROUP BY doc_id, run
), hashed AS (
    SELECT run, times, xor(list_reduce(
        list_transform(range(strlen(x)), lambda i: CAST(('0x' || substr(hex(encode(x)), 2 * i + 1, 2)) AS BIGINT)),
        lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1]), CAST(4294967295 AS BIGINT)), 4294967295) AS h
    FROM (SELECT run, times, doc_id || ':' || run AS x FROM runs), crc
), counted AS MATERIALIZED (
    SELECT word, CAST(sum(times) AS BIGINT) AS n FROM (
        SELECT times, CASE WHEN h % 97 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2)
                           ELSE run END AS word
        FROM hashed
    ) WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3
), shortened AS MATERIALIZED (
    SELECT word, n, i, left(word, i) || substr(word, i + 2) AS less
    FROM (SELECT word, n, unnest(range(length(word))) AS i FROM counted)
), near AS MATERIALIZED (
    SELECT a.word, b.word AS other, b.n FROM shortened a JOIN shortened b ON a.less = b.less AND a.i = b.i AND a.word <> b.word
    UNION
    SELECT a.less, a.word, a.n FROM shortened a JOIN counted b ON a.less = b.word
    UNION
    SELECT a.word, b.word, b.n FROM shortened a JOIN counted b ON a.less = b.word
), forms AS MATERIALIZED (
    SELECT word, c.n, count(other) AS n_near,
           CASE WHEN max(near.n) >= 2 * c.n THEN arg_min(other, (-near.n, other)) END AS form,
           CASE WHEN max(near.n) >= 2 * c.n THEN max(near.n) END AS form_n
    FROM counted c LEFT JOIN near USING (word) GROUP BY word, c.n
), paths(word, reached, steps) AS (
    SELECT word, word, 0 FROM forms
    UNION ALL
    SELECT p.word, f.form, steps + 1 FROM paths p JOIN forms f ON f.word = p.reached WHERE f.form IS NOT NULL
)
SELECT word, form, root, n, n_near, form_n
FROM forms JOIN (SELECT word, arg_max(reached, steps) AS root FROM paths GROUP BY word) USING (word)
"""
