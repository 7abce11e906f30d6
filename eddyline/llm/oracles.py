"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

from eddyline.llm import licences as lic
from eddyline.llm import mixing as mix
from eddyline.llm import urlfilter as url
from eddyline.llm import warc as w


def quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _canonical(text: str) -> str:
    s = f"regexp_replace(lower({text}), {quoted(lic.COPYRIGHT_LINE)}, chr(10), 'g')"
    s = f"' ' || trim(regexp_replace({s}, {quoted(lic.NOT_WORD)}, ' ', 'g')) || ' '"
    for spelt, as_ in lic.EQUIVALENT.items():
        s = f"replace({s}, {quoted(f' {spelt} ')}, {quoted(f' {as_} ')})"
    return f"trim({s})"


def licences() -> str:
    known = ", ".join(f"({quoted(k)}, {quoted(v)})" for k, v in lic.KNOWN.items())
    return f"""
    WITH known AS (
      SELECT sha256(c) AS digest, min(licence) AS licence FROM (
        SELECT licence, {_canonical('body')} AS c FROM (VALUES {known}) k(licence, body))
      WHERE c <> '' GROUP BY 1),
    units AS (
      SELECT doc_id, unnest(u) AS body, generate_subscripts(u, 1) - 1 AS unit FROM (
        SELECT doc_id, [text] || CASE WHEN contains(text, chr(10)) THEN string_split(text, chr(10))
                                 ELSE [] END AS u FROM documents))
    SELECT doc_id, unit::BIGINT AS unit, digest, licence
    FROM (SELECT doc_id, unit, sha256({_canonical('body')}) AS digest FROM units) JOIN known USING (digest)"""


def mixing() -> str:
    return f"""
    WITH RECURSIVE n AS (
      SELECT source, count(*) AS n, floor(sqrt(count(*)::DOUBLE) * {mix.WEIGHT_UNIT})::BIGINT AS w
      FROM documents GROUP BY source),
    rates AS (
      SELECT source, n, (1.0::DOUBLE * (SELECT sum(n) FROM n)::DOUBLE) * w::DOUBLE
                        / (SELECT sum(w) FROM n)::DOUBLE / n AS rate FROM n),
    pieces AS (
      SELECT *, greatest(ceil(rate / {mix.PIECE}), 1)::INT AS parts FROM rates),
    cdf AS (
      SELECT source, rate, parts, rate / parts AS m, 0 AS k, exp(-(rate / parts)) AS p, exp(-(rate / parts)) AS c FROM pieces
      UNION ALL
      SELECT source, rate, parts, m, k + 1, p * m / (k + 1), c + p * m / (k + 1) FROM cdf WHERE k < {mix.TERMS}),
    bounds AS (SELECT source, rate, parts, list(c ORDER BY k) AS cs FROM cdf GROUP BY ALL),
    d AS (
      SELECT documents.*, rate, parts, cs,
             '{mix.SEED}|' || coalesce(doc_id::VARCHAR, chr(0)) || '|' || md5(coalesce(text, chr(0))) AS dig
      FROM documents JOIN bounds ON documents.source IS NOT DISTINCT FROM bounds.source),
    drawn AS (
      SELECT *, list_sum(list_transform(generate_series(1, parts), lambda i:
        len(list_filter(cs, lambda c: c <=
          ('0x' || substr(md5(dig || '|n|' || i::VARCHAR), 1, 13))::BIGINT / {float(1 << 52)})))) AS copies
      FROM d),
    copied AS (SELECT *, unnest(generate_series(0, copies::BIGINT - 1)) AS copy FROM drawn WHERE copies > 0)
    SELECT doc_id, text, lang, source, n_chars, copy, md5(dig || '|o|' || copy::VARCHAR) AS shuffle_key, rate FROM copied"""


def url_filter() -> str:
    order, k = url.ORDER, url.STRENGTH
    rule, says = "CASE ", "CASE "
    for verdict, text in sorted(url.RULES, key=lambda r: (-len(r[1]), r[1])):
        h, slash, p = text.partition("/")
        fits = f"(host = {quoted(h)} OR ends_with(host, {quoted('.' + h)})) AND starts_with(path, {quoted(slash + p)})"
        rule += f"WHEN {fits} THEN {quoted(text)} "
        says += f"WHEN {fits} THEN {quoted(verdict)} "
    start, end = f"repeat(chr({ord(url.START)}), {order})", f"chr({ord(url.END)})"
    tables, joins, pg, pb = "", "", f"{1 / url.SYMBOLS}::DOUBLE", f"{1 / url.SYMBOLS}::DOUBLE"
    for i in range(order + 1):
        tables += f"""
    g{i} AS (SELECT substr(gram, {order + 1 - i}, {i + 1}) AS g, sum(good) AS cg, sum(bad) AS cb FROM grams GROUP BY 1),
    c{i} AS (SELECT substr(g, 1, {i}) AS c, sum(cg) AS tg, sum(cb) AS tb FROM g{i} GROUP BY 1),"""
        joins += f"""
      JOIN g{i} ON g{i}.g = substr(gram, {order + 1 - i}, {i + 1}) JOIN c{i} ON c{i}.c = substr(g{i}.g, 1, {i})"""
        pg = f"((g{i}.cg::DOUBLE + {k} * {pg}) / (c{i}.tg::DOUBLE + {k}))"
        pb = f"((g{i}.cb::DOUBLE + {k} * {pb}) / (c{i}.tb::DOUBLE + {k}))"
    return f"""
    WITH parts AS (
      SELECT page_id, url,
        translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{url.UPPER}', '{url.LOWER}') AS host,
        coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
    ruled AS (SELECT *, {rule} END AS rule, {says} END AS says, coalesce(url, '') AS body FROM parts),
    urls AS (SELECT body, count(*) AS weight, min(says) AS says,
                    substr(md5(body), 1, 1) IN ('0', '1', '2') AS held FROM ruled GROUP BY body),
    spots AS (
      SELECT body, weight, says, held, substr({start} || body || {end}, i::BIGINT, {order + 1}) AS gram
      FROM (SELECT *, unnest(generate_series(1, length(body) + 1)) AS i FROM urls)),
    grams AS (
      SELECT gram, sum(CASE WHEN says = 'allow' AND NOT held THEN weight ELSE 0 END) AS good,
                   sum(CASE WHEN says = 'block' AND NOT held THEN weight ELSE 0 END) AS bad FROM spots GROUP BY gram),{tables}
    scores AS (SELECT gram, round((ln({pg}) - ln({pb})) * 1e6)::BIGINT AS score FROM grams{joins}),
    scored AS (
      SELECT body, any_value(weight) AS weight, any_value(says) AS says, any_value(held) AS held,
             sum(score)::DOUBLE / count(*) AS score
      FROM spots JOIN scores USING (gram) GROUP BY body),
    judged AS (SELECT *, held AS part FROM scored WHERE held UNION ALL SELECT *, false AS part FROM scored),
    sums AS (
      SELECT part, says, sum(weight)::DOUBLE AS n, sum(round(score)::HUGEINT * weight)::DOUBLE AS s,
             sum(round(score)::HUGEINT * round(score)::HUGEINT * weight)::DOUBLE AS q
      FROM judged WHERE says IS NOT NULL GROUP BY part, says),
    stat AS (SELECT part, says, s / n AS mean, sqrt(greatest(q / n - (s / n) * (s / n), 0.0)) + 1.0 AS dev FROM sums),
    cut AS (
      SELECT (a.mean * b.dev + b.mean * a.dev) / (a.dev + b.dev) AS t
      FROM stat a JOIN stat b ON a.part = b.part AND a.says = 'allow' AND b.says = 'block'
      ORDER BY a.part DESC LIMIT 1)
    SELECT page_id, url, host, path, rule,
           coalesce(ruled.says, CASE WHEN (SELECT t FROM cut) IS NULL OR score >= (SELECT t FROM cut)
                                THEN 'allow' ELSE 'block' END) AS verdict,
           round(score)::BIGINT AS score
    FROM ruled JOIN scored USING (body)"""


def _canonical_url(u: str) -> str:
    u = f"regexp_replace({u}, '#.*$', '')"
    scheme = f"translate(regexp_extract({u}, {quoted(w.SCHEME)}, 1), '{url.UPPER}', '{url.LOWER}')"
    rest = f"regexp_replace({u}, {quoted(w.SCHEME)}, '')"
    host = f"translate(regexp_extract({rest}, {quoted(w.HOST)}, 0), '{url.UPPER}', '{url.LOWER}')"
    host = rf"regexp_replace({host}, '^www\.', '')"
    host = (f"CASE WHEN {scheme} = 'https' THEN regexp_replace({host}, ':443$', '') "
            f"WHEN {scheme} IN ('', 'http') THEN regexp_replace({host}, ':80$', '') ELSE {host} END")
    tail = f"regexp_replace({rest}, {quoted(w.HOST)}, '')"
    path = f"regexp_replace(regexp_extract({tail}, '^[^?]*', 0), '/+$', '')"
    query = rf"regexp_replace(regexp_replace({tail}, '^[^?]*\??', ''), {quoted('(^|&)' + w.TRACKING)}, '', 'g')"
    query = f"regexp_replace({query}, '^&', '')"
    return (f"CASE WHEN {scheme} IN ('', 'https') THEN 'http' ELSE {scheme} END || '://' || {host} || {path} "
            f"|| CASE WHEN {query} <> '' THEN '?' || {query} ELSE '' END")


def warc() -> str:
    return f"""
    WITH base AS (
      SELECT page_id, url, sha256(coalesce(html, '')) AS digest,
             {w.START} + (page_id * 7919) % {30 * w.DAY} AS t FROM pages),
    visits AS (
      SELECT *, substr(digest, 1, 16) AS tag, unnest(generate_series(0, page_id % 4)) AS v FROM base),
    rec AS (
      SELECT page_id * 4 + v AS record_id, url, t + v * ({3 * w.DAY} + page_id % 977) AS at_s,
        CASE WHEN v = 0 THEN 'response' ELSE 'revisit' END AS kind, v, tag, {_canonical_url('url')} AS canonical_url,
        CASE WHEN v = 0 THEN tag WHEN (page_id + v) % 5 = 1 THEN tag || 'x'
             WHEN (page_id + v) % 5 IN (2, 3) THEN NULL ELSE tag END AS etag,
        CASE WHEN v = 0 OR (page_id + v) % 5 = 2 THEN t - {w.DAY} END AS modified,
        CASE WHEN v = 0 THEN digest END AS payload FROM visits),
    found AS (
      SELECT *, last_value(CASE WHEN kind = 'response' THEN
          {{'id': record_id, 'digest': payload, 'etag': etag, 'modified': modified}} END IGNORE NULLS)
        OVER (PARTITION BY canonical_url ORDER BY at_s, record_id, kind
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS f FROM rec),
    judged AS (
      SELECT *, CASE WHEN kind = 'response' THEN 'full' WHEN canonical_url IS NULL THEN 'no url or time'
        WHEN f IS NULL THEN 'no earlier response' WHEN etag <> f.etag THEN 'etag differs'
        WHEN (etag IS NULL OR f.etag IS NULL) AND modified <> f.modified THEN 'last-modified differs' ELSE 'resolved' END AS resolution
      FROM found)
    SELECT record_id, url, canonical_url, kind, at_s AS fetched_at, resolution,
      CASE WHEN resolution = 'resolved' THEN f.id END AS refers_to,
      CASE resolution WHEN 'full' THEN payload WHEN 'resolved' THEN f.digest END AS resolved_digest,
      CASE resolution
        WHEN 'full' THEN 'content-length=1;content-type=text/html;date=' || at_s || ';etag=' || tag
        WHEN 'resolved' THEN 'cache-control=max-age=' || v || ';content-length=1;content-type=text/html;date='
             || at_s || ';etag=' || f.etag END AS headers
    FROM judged"""


def lexical() -> str:
    """Every score of an item and a document that share a term, ranked."""
    return r"""
WITH words AS (
  SELECT doc_id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
item_terms AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
len AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
whole AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS total FROM len),
tf AS (SELECT doc_id, term, count(*)::BIGINT AS tf FROM words
       WHERE term IN (SELECT term FROM item_terms) GROUP BY doc_id, term),
weight AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM tf, whole GROUP BY term, n_docs),
part AS (
  SELECT term, doc_id,
         w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // total))) AS part
  FROM tf JOIN weight USING (term) JOIN len USING (doc_id), whole),
score AS (
  SELECT item_id, doc_id, sum(part)::BIGINT AS score
  FROM item_terms JOIN part USING (term) GROUP BY item_id, doc_id),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank,
         doc_id, score
  FROM score WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""
