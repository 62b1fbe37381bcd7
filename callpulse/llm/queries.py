"""Registered queries of the operators here, each over its whole table, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from callpulse.llm.substring_dedup import remove_repeated_passages

    return remove_repeated_passages(_read(spark, sf_dir, "documents"), texts=False)


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from callpulse.llm.minhash import near_duplicates

    return near_duplicates(_read(spark, sf_dir, "documents"), shingle=4, percent=80)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from callpulse.llm.suffix_dedup import remove_repeated_bytes

    return remove_repeated_bytes(_read(spark, sf_dir, "documents"), texts=False)


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from callpulse.llm.language_id import identify_languages

    return identify_languages(_read(spark, sf_dir, "documents"))


def op3_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    from callpulse.llm.html_extract import main_texts

    return main_texts(_read(spark, sf_dir, "pages"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from callpulse.llm.token_counts import context_totals, length_histogram
    from callpulse.llm.workspace import Workspace

    lengths = length_histogram(_read(spark, sf_dir, "documents"), tokenizer_path())
    return context_totals(Workspace(spark, "token-counts").table(lengths, "histogram"))


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from callpulse.llm.fingerprints import neighbour_edits

    return neighbour_edits(_read(spark, sf_dir, "documents"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from callpulse.llm.decontaminate import leaks

    return leaks(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from callpulse.llm.license_scan import license_matches

    return license_matches(_read(spark, sf_dir, "documents"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from callpulse.llm.bpe import encode_texts

    return encode_texts(_read(spark, sf_dir, "documents"), tokenizer_path(), with_ids=False)


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from callpulse.llm.packing import pack_documents

    return pack_documents(_read(spark, sf_dir, "documents"), tokenizer_path(), capacity=1024)


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from callpulse.llm.spelling_variants import spelling_variants

    return spelling_variants(_read(spark, sf_dir, "documents"), shortest=5, least=3)


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from callpulse.llm.conversation_trie import prefix_trie

    return prefix_trie(_read(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_language_id": op2_language_id,
    "op3_html_extract": op3_html_extract,
    "op4_minhash": op4_minhash,
    "op5_token_counts": op5_token_counts,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_fingerprints": op7_fingerprints,
    "op8_decontaminate": op8_decontaminate,
    "op9_license_scan": op9_license_scan,
    "op10_bpe": op10_bpe,
    "op11_packing": op11_packing,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_conversation_trie": op13_conversation_trie,
}

# crc32 of a list of byte values: the table of the reflected polynomial, then one step a byte
_CRC_TABLE = """SELECT list(list_reduce(range(8), lambda a, k: xor(a // 2, 3988292384 * (a % 2)), b) ORDER BY b) AS crc
                FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS b)"""


def _crc32(byte_list: str) -> str:
    return f"xor(list_reduce({byte_list}, lambda a, b: xor(crc[1 + xor(a, b) % 256], a // 256), 4294967295), 4294967295)"


_WORDS = "regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')"

ORACLE_SQL = {
    "op1_substring_dedup": f"""
        WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        win AS (SELECT doc_id, i, sha256(array_to_string(w[i:i + 49], ' ')) AS h
                FROM d, unnest(range(1, len(w) - 48)) AS t(i)),
        lo AS (SELECT h, min(doc_id) AS first FROM win GROUP BY h HAVING min(doc_id) < max(doc_id)),
        hit AS (SELECT DISTINCT win.doc_id, i + k AS p FROM win JOIN lo USING (h), unnest(range(0, 50)) AS u(k) WHERE win.doc_id > first),
        gone AS (SELECT doc_id, list(p) AS ps, count(*) AS n FROM hit GROUP BY doc_id)
        SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
               sha256(array_to_string(CASE WHEN n IS NULL THEN w ELSE
                   list_transform(list_sort(list_filter(list_transform(w, lambda x, j: {{'j': j, 'x': x}}),
                                                       lambda s: NOT list_contains(ps, s.j))), lambda s: s.x) END, ' ')) AS kept_sha256
        FROM d LEFT JOIN gone ON gone.doc_id = d.doc_id""",
    "op4_minhash": f"""
        WITH RECURSIVE d AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
        sh AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS s FROM d, unnest(range(1, greatest(len(w) - 2, 2))) AS t(i)
               WHERE len(w) > 0),
        size AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
        shared AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS m FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
        link AS (SELECT u, v FROM shared JOIN size x ON x.doc_id = u JOIN size y ON y.doc_id = v WHERE 100 * m >= 80 * (x.n + y.n - m)),
        edge AS (SELECT u, v FROM link UNION ALL SELECT v, u FROM link),
        reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, edge.v FROM reach JOIN edge ON edge.u = reach.b),
        comp AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
        SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, d.doc_id = component_id AS kept
        FROM d LEFT JOIN size USING (doc_id) JOIN comp USING (doc_id)""",
    "op6_suffix_dedup": """
        WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
        win AS (SELECT doc_id, i, md5(substr(x, 2 * i + 1, 200)) AS h FROM d, unnest(range(0, CAST(strlen(x) / 2 AS BIGINT) - 99)) AS t(i)),
        ranked AS (SELECT doc_id, i, row_number() OVER (PARTITION BY h ORDER BY doc_id, i) AS k FROM win),
        hit AS (SELECT doc_id, i FROM ranked WHERE k > 1),
        edge AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER o + 100 THEN 0 ELSE 1 END AS fresh FROM hit WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
        run AS (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS r FROM edge),
        span AS (SELECT doc_id, r, min(i) AS a, max(i) + 100 AS b FROM run GROUP BY doc_id, r),
        gone AS (SELECT doc_id, list({'a': a, 'b': b} ORDER BY a) AS s, list(a ORDER BY a) AS sa, list(b ORDER BY a) AS sb,
                        sum(b - a) AS removed, count(*) AS spans FROM span GROUP BY doc_id)
        SELECT d.doc_id, CAST(strlen(x) / 2 AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed,
               CAST(coalesce(spans, 0) AS BIGINT) AS n_spans,
               sha256(unhex(CASE WHEN spans IS NULL THEN x ELSE array_to_string(list_transform(range(0, spans + 1), lambda k:
                   substr(x, CAST(CASE WHEN k = 0 THEN 0 ELSE sb[k] END * 2 + 1 AS BIGINT),
                          CAST((CASE WHEN k = spans THEN strlen(x) / 2 ELSE sa[k + 1] END - CASE WHEN k = 0 THEN 0 ELSE sb[k] END) * 2 AS BIGINT))), '') END)) AS kept_sha256
        FROM d LEFT JOIN gone ON gone.doc_id = d.doc_id""",
    "op8_decontaminate": """
        WITH d AS (SELECT DISTINCT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
        b AS (SELECT DISTINCT item_id, regexp_extract_all(lower(coalesce(text, '')), '[^\\x20\\x09-\\x0D]+') AS w FROM benchmark),
        item AS (SELECT item_id, w, len(w) AS m, least(len(w), 5) AS k FROM b WHERE len(w) > 0),
        gram AS (SELECT item_id, m, k, array_to_string(w[i:i + k - 1], ' ') AS s, count(*) AS c
                 FROM item, unnest(range(1, m - k + 2)) AS t(i) GROUP BY ALL),
        place AS (SELECT doc_id, len(w) AS n, k, i - 1 AS p, array_to_string(w[i:i + k - 1], ' ') AS s
                  FROM d, (SELECT DISTINCT k FROM item) AS kk, unnest(range(1, len(w) - k + 2)) AS t(i)),
        hit AS (SELECT doc_id, n, item_id, m, k, p FROM place JOIN gram USING (k, s)),
        win AS (SELECT doc_id, item_id, m, k, least(m, n) AS z, st, count(*) AS shared
                FROM hit, unnest(range(greatest(p + k - least(m, n), 0), least(p, n - least(m, n)) + 1)) AS t(st) GROUP BY ALL
                HAVING count(*) * 2 >= least(m, n) - k + 1),
        inner_gram AS (SELECT doc_id, item_id, m, k, st, z, array_to_string(w[st + i:st + i + k - 1], ' ') AS s, count(*) AS c
                       FROM win JOIN d USING (doc_id), unnest(range(1, z - k + 2)) AS t(i) GROUP BY ALL),
        score AS (SELECT x.doc_id, x.item_id, x.m, x.st, x.z - x.k + 1 AS t1, x.m - x.k + 1 AS t2, sum(least(x.c, g.c)) AS s
                  FROM inner_gram x JOIN gram g ON g.item_id = x.item_id AND g.s = x.s AND g.m = x.m GROUP BY ALL),
        best AS (SELECT doc_id, item_id, st, m, s / (t1 + t2 - s) AS v FROM score WHERE s / (t1 + t2 - s) >= 0.8)
        SELECT doc_id, item_id, CAST(arg_max(st, [v, -st]) AS INTEGER) AS start_word, CAST(arg_max(m, [v, -st]) AS INTEGER) AS n_words,
               CAST(max(v) AS DOUBLE) AS similarity
        FROM best GROUP BY doc_id, item_id""",
    "op12_spelling_variants": f"""
        WITH RECURSIVE t AS ({_CRC_TABLE}),
        run AS (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                         '[a-z\u00C0-\u00FF]+')) AS w FROM documents),
        own AS (SELECT doc_id, w, count(*) AS c FROM run GROUP BY ALL),
        hash AS (SELECT w, c, {_crc32("""flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || w, ''),
                     lambda x: CASE WHEN unicode(x) < 128 THEN [CAST(unicode(x) AS BIGINT)] ELSE [195, unicode(x) - 64] END))""")} AS h FROM own, t),
        v AS (SELECT CASE WHEN h % 97 = 0 THEN substr(w, 1, CAST(h % length(w) AS BIGINT)) || substr(w, CAST(h % length(w) AS BIGINT) + 2) ELSE w END AS word,
                     CAST(sum(c) AS BIGINT) AS n FROM hash GROUP BY 1 HAVING length(word) >= 5 AND sum(c) >= 3),
        cut AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS less FROM v, unnest(range(1, length(word) + 1)) AS u(i)),
        pair AS (SELECT DISTINCT a.word, b.word AS other FROM cut a JOIN cut b ON a.less = b.less AND a.i = b.i AND a.word <> b.word
                 UNION SELECT cut.word, v.word FROM cut JOIN v ON less = v.word
                 UNION SELECT v.word, cut.word FROM cut JOIN v ON less = v.word),
        near AS (SELECT pair.word, count(*) AS n_near, max(v.n) AS top, min(struct_pack(k := -v.n, w := v.word)) AS best
                 FROM pair JOIN v ON v.word = other GROUP BY pair.word),
        form AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN top >= 2 * v.n THEN best.w END AS form, CASE WHEN top >= 2 * v.n THEN top END AS form_n
                 FROM v LEFT JOIN near USING (word)),
        walk AS (SELECT word, word AS z FROM form UNION ALL SELECT walk.word, form.form FROM walk JOIN form ON form.word = walk.z WHERE form.form IS NOT NULL)
        SELECT form.word, form.form, z AS root, form.n, form.n_near, form.form_n
        FROM walk JOIN form stop ON stop.word = z AND stop.form IS NULL JOIN form ON form.word = walk.word""",
    "op13_conversation_trie": f"""
        WITH t AS ({_CRC_TABLE}),
        turns AS (SELECT conv_id, struct_pack(r := coalesce(role, ''), x := coalesce(text, '')) AS turn,
                         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
                             md5(CAST(strlen(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, ''))) AS k
                  FROM conversations WHERE conv_id IS NOT NULL),
        own AS (SELECT conv_id, list(turn ORDER BY k) AS s FROM turns GROUP BY conv_id),
        h AS (SELECT conv_id, s, CAST({_crc32("list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(unicode(x) AS BIGINT))")} % 9 AS BIGINT) AS h
              FROM own, t),
        conv AS (SELECT h.conv_id, CASE WHEN h.conv_id % 5 = 0 THEN h.s ELSE list_concat(coalesce(base.s, [])[1:h], h.s[h + 1:]) END AS s
                 FROM h LEFT JOIN own base ON base.conv_id = h.conv_id - h.conv_id % 5),
        pre AS (SELECT conv_id, len(s) AS n, d, sha256(to_json(s[1:d])) AS p, sha256(to_json(s[1:d - 1])) AS up, CASE WHEN d > 0 THEN strlen(s[d].x) ELSE 0 END AS b
               FROM conv, unnest(range(0, len(s) + 1)) AS u(d)),
        node AS (SELECT p, d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(up) AS up, any_value(b) AS b,
                        sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE n = d), '')) AS ends_sha256
                 FROM pre GROUP BY p, d),
        kids AS (SELECT up, d - 1 AS d, count(*) AS n_children FROM node WHERE d > 0 GROUP BY ALL),
        full_node AS (SELECT node.*, coalesce(n_children, 0) AS n_children FROM node LEFT JOIN kids ON kids.up = node.p AND kids.d = node.d),
        below AS (SELECT top.p, top.d, sum(CASE WHEN low.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((low.n_convs - 1) * low.b) AS saved_tokens
                  FROM full_node low JOIN pre ON pre.conv_id = low.conv_id AND pre.d <= low.d JOIN full_node top ON top.p = pre.p AND top.d = pre.d GROUP BY ALL)
        SELECT v.conv_id, CAST(v.d AS BIGINT) AS depth, up.conv_id AS parent_conv_id, v.n_convs, CAST(v.n_children AS BIGINT) AS n_children,
               CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, v.ends_sha256
        FROM full_node v JOIN below ON below.p = v.p AND below.d = v.d LEFT JOIN full_node up ON v.d > 0 AND up.p = v.up AND up.d = v.d - 1""",
}
