"""Registered queries of messages, guarded scans, fallback chains and arriving files, with their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxloom.operators import attempts, cluster, documents, joined_hits, labeling, quality, settings
from voxloom.plans import adapters
from voxloom.plans.adapters import read
from voxloom.plans.registry import _QUERIES, _SCORED, _SQL, _scored, query
from voxloom.scratch import hadoop_path, shared_folder, stored
from voxloom.sources import guarded
from voxloom.sources.records import write_records
from voxloom.streaming import rollup

c = F.col


@query(
    f"""WITH {_SCORED} SELECT l_orderkey, l_linenumber, CASE reason WHEN 'too_short' THEN format('Too short: {{:.1f}}s < 2.0s', duration) WHEN 'too_long' THEN format('Too long: {{:.1f}}s > 15.0s', duration)
      WHEN 'low_snr' THEN format('Low SNR: {{:.1f}}dB < 12.0dB', snr) WHEN 'low_speech_ratio' THEN format('Low speech ratio: {{:.2f}} < 0.5', speech_ratio) WHEN 'too_few_words' THEN 'Too few words: ' || word_count || ' < 3'
      WHEN 'incomplete_words' THEN 'Incomplete words/phrases' WHEN 'low_quality' THEN format('Low quality score: {{:.2f}} < 0.5', round(quality, 9)) END AS message FROM j"""
)
def rejection_messages(spark, sf_dir):
    # nine decimals of the score are equal in all engines, its last bits need not be
    rows = _scored(spark, sf_dir).withColumn("quality", F.round("quality", 9))
    return rows.select("l_orderkey", "l_linenumber", quality.reason_message().alias("message"))


@query(
    """WITH l AS (SELECT l_orderkey, l_linenumber, l_quantity / 1.3 AS d, (l_partkey % 40 * 1000)::INTEGER AS r, l_tax * 400 AS s, l_discount / 4 AS k, l_discount * 7.3 AS q, l_quantity / 2.7 AS g, (l_tax - 0.04) / 3 AS o FROM lineitem)
    SELECT l_orderkey, l_linenumber, concat_ws('; ', CASE WHEN d < 1 THEN format('Too short: {:.2f}s (min: 1.0s)', d) WHEN d > 30 THEN format('Too long: {:.2f}s (max: 30.0s)', d) END,
      CASE WHEN r < 16000 THEN 'Sample rate too low: ' || r || 'Hz (min: 16000Hz)' END, CASE WHEN s < 15 THEN format('Low SNR: {:.1f}dB (min: 15dB)', s) END, CASE WHEN k > 0.01 THEN format('Clipping detected: {:.2f}% of samples', k * 100) END,
      CASE WHEN q > 0.5 THEN format('Too much silence: {:.1f}%', q * 100) END, CASE WHEN g < 10 THEN format('Low dynamic range: {:.1f}dB', g) END, CASE WHEN abs(o) > 0.01 THEN format('DC offset detected: {:.3f}', o) END) AS messages FROM l"""
)
def issue_messages(spark, sf_dir):
    m = read(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        (c("l_quantity") / 1.3).alias("duration"),
        (c("l_partkey") % 40 * 1000).cast("int").alias("sample_rate"),
        (c("l_tax") * 400).alias("snr"),
        (c("l_discount") / 4).alias("clipping"),
        (c("l_discount") * 7.3).alias("silence"),
        (c("l_quantity") / 2.7).alias("dynamic_range"),
        ((c("l_tax") - 0.04) / 3).alias("dc_offset"),
    )
    return m.select("l_orderkey", "l_linenumber", F.array_join(quality.issue_messages(), "; ").alias("messages"))


_FILES = """k AS (SELECT conv_id, count(*) AS segments, CASE WHEN conv_id % 7 = 3 THEN 'broken' WHEN conv_id % 11 = 5 THEN 'empty' WHEN conv_id % 13 = 4 THEN 'wrong_shape' END AS error FROM conversations GROUP BY conv_id)"""


def _scanned(spark, sf_dir):
    """A file for each conversation, some cut in half, some empty, some without segments; written, then scanned."""
    folder = shared_folder(spark, "transcripts")
    segment = F.struct((c("turn") * 1.0).alias("start"), (c("turn") + 1.0).alias("end"), "text", c("role").alias("speaker"))
    docs = read(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.to_json(F.struct(F.count("*").cast("double").alias("duration"), F.array_sort(F.collect_list(segment)).alias("segments"))).alias("json"))
    k = c("conv_id")
    content = F.when(k % 7 == 3, F.substring("json", F.lit(1), (F.length("json") / 2).cast("int"))).when(k % 11 == 5, "").when(k % 13 == 4, '{"duration": 1.0}').otherwise(c("json"))
    write_records(docs.select(F.concat(k.cast("string"), F.lit(".json")).alias("name"), content.alias("content")), folder)
    return guarded.scan_transcripts(spark, folder)


@query(f"WITH {_FILES} SELECT conv_id::VARCHAR AS episode, error, CASE WHEN error IS NULL THEN segments END::INTEGER AS segments FROM k")
def guarded_transcripts(spark, sf_dir):
    return _scanned(spark, sf_dir).select(c("stem").alias("episode"), "error", F.when(c("error").isNull(), F.size("value.segments")).alias("segments"))


@query(f"WITH {_FILES} SELECT coalesce(error, 'ok') AS outcome, count(*) AS n FROM k GROUP BY 1")
def guarded_totals(spark, sf_dir):
    return guarded.totals(_scanned(spark, sf_dir))


@query("SELECT conv_id::VARCHAR AS episode, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text)::INTEGER - 1 AS ordinal, turn::DOUBLE AS start, role AS speaker, text FROM conversations WHERE NOT (conv_id % 7 = 3 OR conv_id % 11 = 5 OR conv_id % 13 = 4)")
def guarded_segments(spark, sf_dir):
    return guarded.segments_of(_scanned(spark, sf_dir)).select("episode", "ordinal", "start", "speaker", "text")


def _peak():
    return F.array_max(F.transform("samples", lambda x: F.abs(x)))


def _gain(rows):
    """Twice as loud, where nothing would clip."""
    return rows.withColumn("louder", F.when(_peak() <= 0.9, F.transform("samples", lambda x: x * 2))).withColumn("error", F.when(_peak() > 0.9, "would clip"))


def _limit(rows):
    """Cut off at 0.9, where that changes few samples."""
    over = F.size(F.filter("samples", lambda x: F.abs(x) > 0.9))
    cut = F.transform("samples", lambda x: F.greatest(F.lit(-0.9), F.least(F.lit(0.9), x)) * 2)
    return rows.withColumn("louder", F.when(over <= 1, cut)).withColumn("error", F.when(over > 1, F.concat(F.lit("over the limit: "), over.cast("string"))))


def _scale(rows):
    """To a peak of one, where it isn't far over it."""
    return rows.withColumn("louder", F.when(_peak() <= 1.2, F.transform("samples", lambda x: x / _peak()))).withColumn("error", F.when(_peak() > 1.2, "too loud"))


LOUDER = [("gain", _gain), ("limit", _limit), ("scale", _scale)]
_LOUDER_SQL = """p AS (SELECT clip_id, samples, list_max(list_transform(samples, lambda x: abs(x))) AS peak, len(list_filter(samples, lambda x: abs(x) > 0.9)) AS n_over FROM clip),
    t AS (SELECT clip_id, CASE WHEN peak <= 0.9 THEN 'gain' WHEN n_over <= 1 THEN 'limit' WHEN peak <= 1.2 THEN 'scale' END AS method,
      CASE WHEN peak <= 0.9 THEN '' WHEN n_over <= 1 THEN 'gain: would clip' ELSE 'gain: would clip, limit: over the limit: ' || n_over || CASE WHEN peak > 1.2 THEN ', scale: too loud' ELSE '' END END AS failures,
      CASE WHEN peak <= 0.9 THEN list_transform(samples, lambda x: x * 2) WHEN n_over <= 1 THEN list_transform(samples, lambda x: greatest(-0.9, least(0.9, x)) * 2) WHEN peak <= 1.2 THEN list_transform(samples, lambda x: x / peak) END AS louder FROM p)"""


def _louder(spark, sf_dir):
    return attempts.first_success(adapters.clips(spark, sf_dir), LOUDER, shared_folder(spark, "louder"))


@query(f"+ {_LOUDER_SQL} SELECT clip_id, method, failures, round(list_sum(louder), 6) AS total FROM t", ("clip",))
def fallback_chain(spark, sf_dir):
    said = F.array_join(F.transform("failures", lambda f: F.concat_ws(": ", f["method"], f["error"])), ", ")
    total = F.aggregate("louder", F.lit(0.0), lambda a, x: a + x)
    return _louder(spark, sf_dir).select("clip_id", "method", said.alias("failures"), F.round(total, 6).alias("total"))


@query(f"+ {_LOUDER_SQL}, s(k, name) AS (VALUES (1, 'gain'), (2, 'limit'), (3, 'scale'), (4, 'none')), m AS (SELECT CASE method WHEN 'gain' THEN 1 WHEN 'limit' THEN 2 WHEN 'scale' THEN 3 ELSE 4 END AS place FROM t) SELECT name AS method, count(*) FILTER (place >= k) AS seen, count(*) FILTER (place = k AND k < 4) AS worked FROM s, m GROUP BY name", ("clip",))
def fallback_report(spark, sf_dir):
    tried = stored(_louder(spark, sf_dir).select("method", "failures"), shared_folder(spark, "tried"))
    return attempts.chain_report(tried, [n for n, _ in LOUDER])


def arrival_speaker_analysis(spark, sf_dir):
    """A stream over the files of events; its totals are those of speaker_analysis."""
    events = read(spark, sf_dir, "events")
    folder = shared_folder(spark, "arrivals")
    # a file stream takes a folder: that of the files, or for a table of one file the one it lies in
    fs, target = hadoop_path(spark, f"{sf_dir}/events.parquet")
    where, names = (sf_dir, "events.parquet") if fs.getFileStatus(target).isFile() else (f"{sf_dir}/events.parquet", "*.parquet")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 4).option("pathGlobFilter", names).option("recursiveFileLookup", "true").parquet(where)
    rollup.follow(adapters.segments_of(stream), folder).awaitTermination()
    return rollup.speaker_totals(rollup.current_partials(spark, folder)).withColumn("total_duration", F.round("total_duration", 6))


_QUERIES["arrival_speaker_analysis"] = arrival_speaker_analysis
_SQL["arrival_speaker_analysis"] = _SQL["speaker_analysis"]


JOINED = [("anna", 0, "the"), ("anna", 1, "n i"), ("ben", 2, "is.*of"), ("ben", 3, "[aeiou] [aeiou]")]


@query(
    r"""+ p(label, pattern) AS (VALUES ('anna', 'the'), ('anna', 'n i'), ('ben', 'is.*of'), ('ben', '[aeiou] [aeiou]')), j AS (SELECT speaker, count(*) AS n, (count(*) FILTER (regexp_matches(text, '(?i)ing|tion')))::DOUBLE / count(*) AS theme, string_agg(lower(text), ' ' ORDER BY episode::BIGINT, ordinal) AS whole FROM utt GROUP BY speaker),
    h AS (SELECT speaker, label, sum(len(regexp_extract_all(whole, pattern)))::BIGINT AS hits FROM j CROSS JOIN p GROUP BY 1, 2)
    SELECT h.speaker, label, hits, round(hits::DOUBLE / n * greatest(0.0, 1 - 2 * theme), 6) AS score FROM h JOIN j ON j.speaker = h.speaker""",
    ("utt",),
)
def joined_pattern_scores(spark, sf_dir):
    u = adapters.utterances(spark, sf_dir).withColumn("place", c("episode").cast("long"))
    out = joined_hits.joined_scores(u, JOINED, labeling.theme_ratio(u, ["ing", "tion"]), "speaker", ["place", "ordinal"])
    return out.select("speaker", "label", "hits", F.round("score", 6).alias("score"))


_DOCUMENTS = r"""s AS (SELECT vec_id % 12 AS cluster_id, conv_id::VARCHAR AS episode, 5000 - conv_id AS position, turn * 7.5 AS time, role AS speaker, trim(text, ' ' || chr(9) || chr(10) || chr(13)) AS text FROM conversations JOIN (SELECT DISTINCT conv_id AS id, conv_id * 7 % 11 AS vec_id FROM conversations) ON id = conv_id WHERE trim(text, ' ' || chr(9) || chr(10) || chr(13)) <> ''),
    g AS (SELECT vec_id % 12 AS cluster_id, count(*) AS segments, sum(1.0 + vec_id % 7)::DOUBLE AS seconds, count(DISTINCT vec_id % 20) AS n_episodes, string_agg(DISTINCT label::VARCHAR, ', ' ORDER BY label::VARCHAR) AS speakers FROM embeddings GROUP BY 1),
    n AS (SELECT cluster_id, position, episode, count(*) AS n FROM s GROUP BY ALL), t AS (SELECT cluster_id, sum(n)::BIGINT AS total FROM n GROUP BY 1)"""


def _documents(spark, sf_dir):
    v = read(spark, sf_dir, "embeddings").withColumn("cluster_id", c("vec_id") % 12)
    clusters = v.groupBy("cluster_id").agg(F.count("*").alias("segments"), F.sum(1.0 + c("vec_id") % 7).alias("total_duration"), F.count_distinct(c("vec_id") % 20).alias("n_episodes"), F.collect_set(c("label").cast("string")).alias("speakers"))
    clusters = clusters.withColumn("label", F.when(c("cluster_id") % 3 != 0, F.concat(F.lit("voice "), c("cluster_id").cast("string")))).withColumn("quality", F.lit(0.5))
    said = read(spark, sf_dir, "conversations").select((c("conv_id") * 7 % 11 % 12).alias("cluster_id"), c("conv_id").cast("string").alias("episode"), (5000 - c("conv_id")).alias("position"), (c("turn") * 7.5).alias("time"), c("role").alias("speaker"), "text")
    return clusters, said


@query(
    f"""WITH {_DOCUMENTS}, b AS (SELECT cluster_id, position, episode, string_agg('[' || lpad((time::INTEGER // 60)::VARCHAR, 2, '0') || ':' || lpad((floor(time)::INTEGER % 60)::VARCHAR, 2, '0') || '] ' || speaker || ': "' || text || '"', chr(10) ORDER BY time) AS said FROM s GROUP BY ALL)
    SELECT cluster_id, 0 AS block, 0::BIGINT AS position, '' AS episode, 'FULL TRANSCRIPT - Cluster ' || cluster_id || chr(10) || 'Character: ' || CASE WHEN cluster_id % 3 = 0 THEN 'unassigned' ELSE 'voice ' || cluster_id END || chr(10) || format('Total Duration: {{:.1f}} minutes', seconds / 60) || chr(10)
      || 'Original Speakers: ' || speakers || chr(10) || 'Episodes: ' || n_episodes || chr(10) || repeat('=', 60) || chr(10) AS text FROM g
    UNION ALL SELECT cluster_id, 1, 0, '', 'No dialogue found for this cluster.' FROM g WHERE cluster_id NOT IN (SELECT cluster_id FROM t)
    UNION ALL SELECT cluster_id, 1, position, episode, chr(10) || '--- ' || episode || ' ---' || chr(10) || chr(10) || said FROM b
    UNION ALL SELECT t.cluster_id, 2, 0, '', chr(10) || repeat('=', 60) || chr(10) || 'SUMMARY:' || chr(10) || 'Total lines: ' || total || chr(10) || 'Lines by episode:' || chr(10) || x FROM t JOIN (SELECT cluster_id, string_agg('  ' || episode || ': ' || n || ' lines', chr(10) ORDER BY episode) AS x FROM n GROUP BY 1) y ON y.cluster_id = t.cluster_id"""
)
def transcript_documents(spark, sf_dir):
    return documents.sections(documents.transcript_lines(*_documents(spark, sf_dir)))


@query(
    f"""WITH {_DOCUMENTS}, e AS (SELECT DISTINCT cluster_id, episode, position FROM s), r AS (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY position) AS k FROM e),
    f AS (SELECT cluster_id, string_agg(chr(10) || '  - ' || episode, '' ORDER BY k) AS first FROM r WHERE k <= 5 GROUP BY 1)
    SELECT g.cluster_id, 'Cluster ID: ' || g.cluster_id || chr(10) || 'Character: ' || CASE WHEN g.cluster_id % 3 = 0 THEN 'unassigned' ELSE 'voice ' || g.cluster_id END || chr(10) || format('Duration: {{:.1f}} minutes', seconds / 60) || chr(10) || 'Episodes: ' || n_episodes || chr(10) || 'Segments: ' || segments || chr(10) || 'Quality Score: 0.5' || chr(10)
      || 'Original Speakers: ' || speakers || chr(10) || chr(10) || 'First few episodes:' || coalesce(first, '') AS text FROM g LEFT JOIN f ON f.cluster_id = g.cluster_id"""
)
def cluster_documents(spark, sf_dir):
    clusters, said = _documents(spark, sf_dir)
    lines = documents.info_lines(clusters, said.select("cluster_id", "episode", "position").distinct())
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "position", "k", "line"))), lambda x: x["line"]), "\n")
    return lines.groupBy("cluster_id").agg(text.alias("text"))


# lenient speakers have a file of their own over the shared one; two of the values can't be used
LAYERS = [
    ("strict", 0, "quality_thresholds.min_duration", "4"),
    ("strict", 0, "quality_thresholds.min_snr_db", "14.5"),
    ("strict", 1, "quality_thresholds.min_word_count", "4"),
    ("strict", 1, "quality_thresholds.min_duration", "five"),
    ("lenient", 0, "quality_thresholds.max_duration", "20.0"),
    ("lenient", 1, "quality_thresholds.max_duration", "40.0"),
    ("lenient", 1, "quality_thresholds.min_speech_ratio", "1.5"),
]


@query(
    f"""WITH {_SCORED.split(' j AS (')[0].rstrip().rstrip(',')}, p AS (SELECT *, CASE l_suppkey % 3 WHEN 0 THEN 'strict' WHEN 1 THEN 'lenient' ELSE 'plain' END AS profile FROM (SELECT h.*, speaker::BIGINT AS l_suppkey FROM h)),
    s AS (SELECT *, CASE profile WHEN 'strict' THEN 4.0 ELSE 2.0 END AS low, CASE profile WHEN 'lenient' THEN 40.0 ELSE 15.0 END AS high, CASE profile WHEN 'strict' THEN 14.5 ELSE 12.0 END AS least, CASE profile WHEN 'strict' THEN 4 ELSE 3 END AS words FROM p)
    SELECT l_orderkey, l_linenumber, profile, CASE WHEN duration < low THEN 'too_short' WHEN duration > high THEN 'too_long' WHEN snr < least THEN 'low_snr' WHEN speech_ratio < 0.5 THEN 'low_speech_ratio' WHEN word_count < words THEN 'too_few_words' WHEN NOT complete THEN 'incomplete_words' WHEN quality < 0.5 THEN 'low_quality' END AS reason FROM s"""
)
def cascade_by_settings(spark, sf_dir):
    key = c("speaker").cast("long") % 3
    rows = _scored(spark, sf_dir).drop("reason").withColumn("profile", F.when(key == 0, "strict").when(key == 1, "lenient").otherwise("plain"))
    layers = settings.resolved(spark.createDataFrame(LAYERS, settings.LAYERS), settings.ACCEPT)
    rules = quality.AcceptRules(*[c(s.column) for s in settings.ACCEPT])
    return settings.with_settings(rows, layers, settings.ACCEPT).select("l_orderkey", "l_linenumber", "profile", quality.reason(rules).alias("reason"))


# no SQL twin: tests hold the cut against the textbook form
def ward_clusters(spark, sf_dir):
    return cluster.cluster_voices(adapters.voices(spark, sf_dir), "hierarchical", expected=7)


_QUERIES["ward_clusters"] = ward_clusters
