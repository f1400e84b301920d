"""The queries that SQL can express, as DuckDB SQL over the same tables."""

from __future__ import annotations

from tillflow.llm import decontaminate, mixing, phrases, rules, secrets, warc


def _quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _secret_scan() -> str:
    """Positions are the lengths of the pieces before a match; only texts with a match are walked."""
    each = []
    for place, rule in enumerate(secrets.RULES):
        pattern = _quoted(rule.pattern)
        each.append(f"""
        SELECT doc_id, '{rule.kind}' AS kind, {place} AS place,
               list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[1:i-1], lambda x: length(x))), 0) AS start,
               length(hits[i]) AS n
        FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS i
              FROM (SELECT doc_id, regexp_extract_all(body, {pattern}) AS hits, regexp_split_to_array(body, {pattern}) AS gaps,
                           regexp_extract_all(body, {pattern}, {rule.group}) AS checked
                    FROM texts WHERE regexp_matches(body, {pattern})))
        WHERE length(checked[i]) >= {rule.least}""")
    union = " UNION ALL ".join(each)
    base = ", ".join(f"'{rule.kind}'" for rule in secrets.BASE)
    joined = "string_agg(concat(kind, ':', start, ':', start + n), ',' ORDER BY start, place)"
    counts = ", ".join(f"coalesce(count(*) FILTER (kind = '{rule.kind}'), 0) AS n_{rule.kind}" for rule in secrets.BASE)
    return f"""
    WITH texts AS (SELECT doc_id, coalesce(text, '') AS body FROM documents), found AS ({union}),
    per_doc AS (SELECT doc_id, {counts}, {joined} FILTER (kind IN ({base})) AS base, {joined} AS spans FROM found GROUP BY doc_id)
    SELECT t.doc_id, {", ".join(f"coalesce(n_{rule.kind}, 0)::BIGINT AS n_{rule.kind}" for rule in secrets.BASE)},
           sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, sha256(t.body) AS blob
    FROM texts t LEFT JOIN per_doc p ON t.doc_id IS NOT DISTINCT FROM p.doc_id"""


def _quality_rules() -> str:
    """Windows are lists of eight words; the binomial tail uses the gamma function."""
    names, levels, last = rules.RULES, range(rules.LEVELS), rules.LEVELS
    bins = ", ".join(f"least(ceil({value} * 1000), {rules.CAP})::BIGINT AS {name}" for name, value in (
        ("symbols_per_word", "(n_symbols / greatest(n_words, 1))"), ("dup_line_share", "(n_dup_lines / greatest(n_lines, 1))"),
        ("repeat_share", "(n_repeat_words / greatest(n_words, 1))"), ("mean_word_chars", "(word_chars / greatest(n_words, 1))"),
    ))
    cutoffs = [f"floor(max(v) * {times} / 1000)::BIGINT + {margin}" for times, margin in rules.MULTIPLES]
    quantiles = ", ".join(cutoffs + [f"min(v) FILTER (up_to * 1000 >= n_all * {share})" for share in rules.QUANTILES])
    pivot = ", ".join(f"any_value(cuts) FILTER (rule = '{name}') AS cuts_{name}" for name in names)
    above = lambda level: "(" + " OR ".join(f"{name} > cuts_{name}[{level}]" for name in names) + ")"
    rejected = ", ".join(f"count(*) FILTER ({above(level + 1)})" for level in levels)
    limit = ", ".join(f"cuts_{name}[levels] AS cut_{name}" for name in names)
    over = " OR ".join(f"coalesce({name} > cut_{name}, false)" for name in names)
    return rf"""
    WITH split AS (
      SELECT doc_id, coalesce(lang, '') AS stratum, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
             list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l,
             len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]'))::BIGINT AS n_symbols
      FROM documents),
    windows AS (SELECT doc_id, i, list_slice(w, i, i + 7) AS eight FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM split)),
    twice AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, eight) > 1),
    covered AS (SELECT doc_id, count(DISTINCT p)::BIGINT AS n_repeat_words FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY doc_id),
    measured AS (
      SELECT s.doc_id, stratum, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
             n_symbols, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, len(l) AS n_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
      FROM split s LEFT JOIN covered USING (doc_id)),
    rated AS (SELECT *, {bins} FROM measured),
    good AS (
      SELECT r.*, md5('{rules.SEED}|' || r.doc_id::VARCHAR)[1] IN ('0', '1', '2', '3') AS proposing
      FROM rated r JOIN (SELECT doc_id FROM labels GROUP BY doc_id HAVING min(quality) = 1) USING (doc_id)),
    long AS (UNPIVOT (SELECT stratum, {", ".join(names)} FROM good WHERE proposing) ON {", ".join(names)} INTO NAME rule VALUE v),
    summed AS (
      SELECT stratum, rule, v, sum(count(*)) OVER (PARTITION BY stratum, rule ORDER BY v) AS up_to,
             sum(count(*)) OVER (PARTITION BY stratum, rule) AS n_all
      FROM long GROUP BY stratum, rule, v),
    per_rule AS (SELECT stratum, rule, [{quantiles}] AS cuts FROM summed GROUP BY stratum, rule),
    cuts AS (SELECT stratum, {pivot} FROM per_rule GROUP BY stratum),
    counted AS (SELECT stratum, count(*) AS n, [{rejected}] AS ks FROM good JOIN cuts USING (stratum) WHERE NOT proposing GROUP BY stratum),
    tested AS (
      SELECT stratum, list_transform(ks, lambda k: CASE WHEN k > n * {rules.RISK} THEN 1 ELSE list_sum(list_transform(range(0, k + 1), lambda i:
        exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({rules.RISK}) + (n - i) * ln(1 - {rules.RISK})))) END) AS tails
      FROM counted),
    ranked AS (SELECT *, row_number() OVER (ORDER BY list_max(tails), stratum) AS r, count(*) OVER () AS m FROM tested),
    shared AS (SELECT *, coalesce(min(CASE WHEN list_max(tails) > {rules.DELTA} / (m - r + 1) THEN r END) OVER () - 1, m) AS whole FROM ranked),
    passed AS (SELECT stratum, coalesce(list_position(list_transform(tails, lambda t: t > {rules.DELTA} / greatest(m - whole, 1)), true) - 1, {last}) AS levels FROM shared),
    limits AS (SELECT stratum, {limit} FROM cuts JOIN passed USING (stratum) WHERE levels > 0)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
           (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
           NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND NOT ({over}) AS kept, stratum
    FROM rated LEFT JOIN limits USING (stratum)"""


def _mixing() -> str:
    """All quotients are listed, and the highest of them taken."""
    block, seed, digits = mixing.BLOCK_WORDS, mixing.SEED, mixing.BUCKET_DIGITS
    weights = ", ".join(map(str, mixing.WEIGHTS))
    # Where each shard begins: the quota of the shards before it, in words.
    houses = ", ".join(f"count(*) FILTER (nth <= (house::BIGINT * {shard}) // {mixing.SHARDS}) * {block}" for shard in range(1, mixing.SHARDS))
    chosen = lambda k: f"(((({k}) + o)::HUGEINT * rest) // n_blocks - (o::HUGEINT * rest) // n_blocks)"
    before = lambda x: f"({chosen(f'({x}) // {block}')} * {block} + (({x}) % {block}) * ({chosen(f'({x}) // {block} + 1')} - {chosen(f'({x}) // {block}')}))"
    return rf"""
    WITH keyed AS (
      SELECT doc_id, source, coalesce('s' || source, 'n') AS key, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
             md5('{seed}|' || coalesce(doc_id::VARCHAR, '#' || md5(coalesce(text, '')))) AS place
      FROM documents),
    sized AS (SELECT key, source, sum(size)::BIGINT AS source_size FROM keyed GROUP BY key, source),
    weighed AS (
      SELECT *, [{weights}][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)} + 1)::INT] AS weight,
             {mixing.MOST} * source_size AS cap, sum(source_size) OVER () AS total
      FROM sized),
    levels AS (
      SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY cap / weight, key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
                / (sum(weight) OVER (ORDER BY cap / weight, key ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS here,
             row_number() OVER (ORDER BY cap / weight, key) AS nth
      FROM weighed),
    targets AS (
      SELECT key, source, source_size, total, greatest(-(-source_size // {block}), (source_size + {block} - 1) // {block}) AS blocks,
             least(cap::DOUBLE, (SELECT arg_min(here, nth) FROM levels WHERE here * weight <= cap) * weight) AS target,
             row_number() OVER (ORDER BY source NULLS LAST) AS place_
      FROM levels),
    seats AS (
      SELECT key, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, place_) AS nth, round_even(total / {block}, 0) AS house
      FROM (SELECT *, unnest(range(0, (least({mixing.MOST} * blocks, ceil(2 * target / {block}) + 2))::BIGINT)) AS k FROM targets) WHERE target > 0),
    quotas AS (
      SELECT key, count(*) FILTER (nth <= house) AS quota, [0, {houses}] AS bounds FROM seats GROUP BY key),
    plan AS (
      SELECT t.key, source_size, target, greatest(blocks, 1) AS n_blocks, coalesce(bounds, [0 FOR x IN range({mixing.SHARDS})]) AS bounds,
             CASE WHEN source_size > 0 THEN least({mixing.MOST}, coalesce(quota, 0) * {block} // source_size) ELSE 0 END AS passes,
             CASE WHEN source_size > 0 AND coalesce(quota, 0) * {block} // source_size < {mixing.MOST}
                  THEN least(blocks, (coalesce(quota, 0) * {block} % source_size + {block // 2}) // {block}) ELSE 0 END AS rest,
             ('0x' || substr(md5('{seed}#' || t.key), 1, 8))::BIGINT % greatest(blocks, 1) AS o
      FROM targets t LEFT JOIN quotas q ON t.key = q.key),
    placed AS (
      SELECT *, coalesce(sum(size) OVER (PARTITION BY key ORDER BY substr(place, 1, {digits}), place, size
                                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS begin_
      FROM keyed),
    mixed AS (
      SELECT *, (passes * size + {before("begin_ + size")} - {before("begin_")})::BIGINT AS taken, (passes * source_size + {before("begin_")})::BIGINT AS partial_at
      FROM placed JOIN plan USING (key)),
    cut AS (
      SELECT *, list_concat(list_transform(range(0, passes::BIGINT), lambda p: [p * source_size + begin_, p * source_size + begin_ + size]),
                            [[partial_at, partial_at + taken - (passes * size)::BIGINT]]) AS pieces
      FROM mixed)
    SELECT doc_id, size::BIGINT AS size, source_size, target, taken, source,
           array_to_string(list_transform(range(1, {mixing.SHARDS + 1}), lambda s: list_sum(list_transform(pieces, lambda x:
             greatest(least(x[2], coalesce(bounds[s + 1], {2**62})) - greatest(x[1], bounds[s]), 0)))::BIGINT), ',') AS shard_words
    FROM cut"""


def _urn(*parts: str) -> str:
    digest = f"sha256(concat_ws('|', {', '.join(parts)}))"
    cut = lambda at, n: f"substr({digest}, {at}, {n})"
    return f"concat('<urn:uuid:', {cut(1, 8)}, '-', {cut(9, 4)}, '-8', {cut(13, 3)}, '-a', {cut(16, 3)}, '-', {cut(19, 12)}, '>')"


def _warc() -> str:
    text = f"regexp_replace(payload, {_quoted(warc.UNSEEN)}, '', 'g')"
    text = f"regexp_replace(regexp_replace({text}, {_quoted(warc.BREAKS)}, chr(10), 'g'), {_quoted(warc.TAGS)}, '', 'g')"
    for name, value in warc.ENTITIES.items():
        text = f"replace({text}, {_quoted(name)}, {_quoted(value)})"
    text = rf"regexp_replace({text}, '[\x20\t\x0B\f\r]+', ' ', 'g')"
    text = rf"regexp_replace(regexp_replace({text}, ' ?\n[ \n]*', chr(10), 'g'), '^[ \n]+|[ \n]+$', '', 'g')"
    line = "chr(13) || chr(10)"
    field = lambda name, value: f"'{name}: ' || {value} || {line}"
    facts = " || ".join([
        f"array_to_string(list_transform(string_split(http_headers, {line}), lambda x: 'source-header: ' || x || {line}), '')",
        field("source-payload-digest", "payload_digest"), field("title", "title"), field("outlinks", "len(links)"),
        rf"coalesce(array_to_string(list_transform(links, lambda x: 'outlink: ' || regexp_replace(x, '[\r\n]+', ' ', 'g') || {line}), ''), '')",
    ])
    header = " || ".join([
        f"'WARC/1.1' || {line}", field("WARC-Type", "record_type"), field("WARC-Record-ID", "own_id"), field("WARC-Refers-To", "record_id"),
        field("WARC-Target-URI", "target_uri"), field("WARC-Date", _quoted(warc.DATE)), field("WARC-Block-Digest", "block_digest"),
        field("WARC-Source-Payload-Digest", "payload_digest"), field("Content-Type", "content_type"), field("Content-Length", "content_length"),
    ])
    return rf"""
    WITH source AS (
      SELECT page_id, coalesce(url, '') AS target_uri, coalesce(html, '') AS payload,
             'HTTP/1.1 200 OK' || {line} || 'Content-Type: text/html; charset=utf-8' || {line} || 'Content-Length: ' || strlen(coalesce(html, '')) AS http_headers
      FROM pages),
    kept AS (
      SELECT page_id, {_urn("'response'", "coalesce(page_id::VARCHAR, '')", "target_uri", "sha256(payload)")} AS record_id, target_uri, http_headers,
             'sha256:' || sha256(payload) AS payload_digest, {text} AS text,
             trim(regexp_replace(regexp_extract(payload, {_quoted(warc.TITLE)}, 1), '[\x20\x09-\x0D]+', ' ', 'g')) AS title,
             regexp_extract_all(payload, {_quoted(warc.LINKS)}, 1) AS links
      FROM source),
    blocks AS (
      SELECT page_id, record_id, target_uri, payload_digest, 'metadata' AS record_type, 'application/warc-fields' AS content_type, {facts} AS block FROM kept
      UNION ALL
      SELECT page_id, record_id, target_uri, payload_digest, 'conversion', 'text/plain; charset=utf-8', text FROM kept),
    own AS (SELECT *, {_urn("record_type", "record_id")} AS own_id, 'sha256:' || sha256(block) AS block_digest, strlen(block) AS content_length FROM blocks)
    SELECT page_id, record_type, own_id AS record_id, record_id AS refers_to, target_uri, content_type, content_length::BIGINT AS content_length,
           block_digest, payload_digest, {header} || {line} || block AS record
    FROM own"""


def _lowered(text: str) -> str:
    return f"translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _phrases() -> str:
    """All runs of words are listed and counted; parts and longer candidates are looked up by their text."""
    return rf"""
    WITH pieces AS (
      SELECT doc_id, coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(regexp_split_to_array({_lowered("text")}, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w
      FROM documents),
    total AS (SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang),
    places AS (SELECT doc_id, lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces),
    grams AS (
      SELECT lang, words, array_to_string(w[i:i + words - 1], ' ') AS phrase, count(*) AS a, min(doc_id) AS first_doc
      FROM places, (SELECT unnest(range(1, {phrases.LONGEST + 1})) AS words) WHERE i + words - 1 <= len(w)
      GROUP BY ALL HAVING count(*) >= {phrases.LEAST}),
    candidates AS (SELECT *, string_split(phrase, ' ') AS p FROM grams WHERE words > 1),
    cuts AS (SELECT *, unnest(range(1, words)) AS k FROM candidates),
    rated AS (
      SELECT c.lang, c.phrase, c.k, x.a AS l, y.a AS r, {phrases.SCALE}::HUGEINT * c.a // (x.a + y.a) AS score
      FROM cuts c JOIN grams x ON x.lang = c.lang AND x.phrase = array_to_string(p[1:k], ' ')
      JOIN grams y ON y.lang = c.lang AND y.phrase = array_to_string(p[k + 1:], ' ')),
    best AS (SELECT * FROM rated QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
    shorter AS (SELECT lang, a, p, words, unnest(range(2, words)) AS m FROM candidates WHERE words > 2),
    within AS (SELECT lang, a, array_to_string(p[i:i + m - 1], ' ') AS phrase FROM (SELECT *, unnest(range(1, words - m + 2)) AS i FROM shorter)),
    around AS (SELECT lang, phrase, max(a) AS around FROM within GROUP BY ALL)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score::BIGINT AS score, first_doc
    FROM candidates JOIN best USING (lang, phrase) JOIN total USING (lang) LEFT JOIN around USING (lang, phrase)
    WHERE around IS NULL OR 100::HUGEINT * around < {phrases.INSIDE_PERCENT}::HUGEINT * a
    QUALIFY rank <= {phrases.PER_LANG}"""


def _decontaminate() -> str:
    """All runs of words of the windows' lengths are listed; near windows are looked up term by term."""
    apart, words, slop = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", decontaminate.WORDS, decontaminate.SLOP
    return rf"""
    WITH split AS (SELECT doc_id, regexp_extract_all({_lowered("text")}, '{apart}') AS w FROM documents),
    items AS (SELECT item_id::VARCHAR AS item, regexp_extract_all({_lowered("text")}, '{apart}') AS w FROM benchmark),
    windows AS (
      SELECT DISTINCT item, array_to_string(w[i:i + {words - 1}], ' ') AS phrase, w[i:i + {words - 1}] AS terms
      FROM (SELECT item, w, unnest(range(1, greatest(len(w) - {words - 1}, 1) + 1)) AS i FROM items WHERE len(w) > 0)),
    sizes AS (SELECT DISTINCT len(terms) AS size FROM windows),
    runs AS (
      SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS phrase
      FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM split), sizes WHERE i + size - 1 <= len(w)),
    met AS (SELECT DISTINCT doc_id, i, size, item FROM runs JOIN windows USING (phrase)),
    hit AS (SELECT doc_id, count(DISTINCT p)::BIGINT AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM met) GROUP BY doc_id),
    found AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM met GROUP BY doc_id),
    words AS (SELECT doc_id, unnest(w) AS term, unnest(range(1, len(w) + 1)) AS pos FROM split),
    asked AS (SELECT DISTINCT phrase, unnest(terms) AS term, unnest(range(0, len(terms))) AS off FROM windows),
    postings AS (SELECT * FROM words SEMI JOIN asked USING (term)),
    counts AS (SELECT term, count(*) AS n FROM postings GROUP BY term),
    ranked AS (SELECT a.*, row_number() OVER (PARTITION BY phrase ORDER BY n, off) AS nth, count(*) OVER (PARTITION BY phrase) AS size FROM asked a JOIN counts USING (term)),
    open AS (SELECT r.phrase, size, p.doc_id, pos - off AS start FROM ranked r JOIN postings p USING (term) WHERE nth = 1),
    thinned AS (
      SELECT DISTINCT o.* FROM open o JOIN ranked r ON r.phrase = o.phrase AND nth = 2
      JOIN postings p ON p.doc_id = o.doc_id AND p.term = r.term AND p.pos BETWEEN start + off - {slop} AND start + off + {slop}),
    near AS (
      SELECT o.phrase, o.doc_id, start FROM thinned o JOIN ranked r USING (phrase)
      JOIN postings p ON p.doc_id = o.doc_id AND p.term = r.term AND p.pos BETWEEN start + off - {slop} AND start + off + {slop}
      GROUP BY ALL HAVING count(DISTINCT off) = any_value(o.size)),
    near_items AS (SELECT doc_id, count(DISTINCT item) AS n_near_items FROM near JOIN windows USING (phrase) GROUP BY doc_id)
    SELECT s.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
           sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near_items, 0)::BIGINT AS n_near_items
    FROM split s LEFT JOIN hit USING (doc_id) LEFT JOIN found USING (doc_id) LEFT JOIN near_items USING (doc_id)"""


ORACLE: dict[str, str] = {
    "op13_decontamination": _decontaminate(),
    "op11_phrases": _phrases(),
    "op2_secret_scan": _secret_scan(),
    "op8_quality_rules": _quality_rules(),
    "op9_mixing": _mixing(),
    "op10_warc": _warc(),
}
