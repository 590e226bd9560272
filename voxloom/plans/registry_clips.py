"""Registered queries of cutting, numbering, joining and reporting on clips, with their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from voxloom.functions import signal as S
from voxloom.functions import spectral
from voxloom.functions import text as T
from voxloom.operators import clips, quality, reports
from voxloom.plans import adapters
from voxloom.plans.adapters import read
from voxloom.plans.registry import _METRICS, _SCORED, _metrics, _scored, query

c = F.col


def _round(df, *names, to=6):
    return df.withColumns({n: F.round(n, to) for n in names})


@query(
    f"""WITH {_SCORED}, d AS (SELECT speaker, coalesce(min(duration) FILTER (reason IS NULL), 0.0) AS min_duration, coalesce(max(duration) FILTER (reason IS NULL), 0.0) AS max_duration,
      round(coalesce(min(snr) FILTER (reason IS NULL), 0.0), 6) AS min_snr, round(coalesce(max(snr) FILTER (reason IS NULL), 0.0), 6) AS max_snr, round(coalesce(avg(word_count) FILTER (reason IS NULL), 0.0), 6) AS mean_words FROM j GROUP BY speaker),
    h2 AS (SELECT speaker, string_agg(reason || ':' || n, ',' ORDER BY reason || ':' || n) AS reasons FROM (SELECT speaker, reason, count(*) AS n FROM j WHERE reason IS NOT NULL GROUP BY 1, 2) GROUP BY speaker)
    SELECT d.*, coalesce(reasons, '') AS reasons FROM d LEFT JOIN h2 USING (speaker)"""
)
def speaker_detail(spark, sf_dir):
    return _round(reports.speaker_detail(_scored(spark, sf_dir)), "min_snr", "max_snr", "mean_words")


@query(
    f"""WITH {_SCORED}, t AS (SELECT sum(n_rejected)::BIGINT AS n_rejected, avg(acceptance_rate) AS acceptance FROM r),
    k AS (SELECT count(*) FILTER (reason = 'too_short') AS s, count(*) FILTER (reason = 'low_snr') AS l, count(*) FILTER (reason = 'incomplete_words') AS w FROM j)
    SELECT n_rejected, round(acceptance, 6) AS acceptance, concat_ws(',', CASE WHEN s::DOUBLE / n_rejected > 0.3 THEN 'many_too_short' END, CASE WHEN l::DOUBLE / n_rejected > 0.2 THEN 'many_low_snr' END,
      CASE WHEN w::DOUBLE / n_rejected > 0.2 THEN 'many_incomplete_words' END, CASE WHEN acceptance < 0.3 THEN 'few_accepted' WHEN acceptance > 0.9 THEN 'nearly_all_accepted' END) AS advice FROM t, k"""
)
def acceptance_advice(spark, sf_dir):
    return _round(reports.advice(_scored(spark, sf_dir)), "acceptance")


@query(
    f"""+ {_METRICS}, s AS (SELECT greatest(0.0, least(10.0, 10.0 - 0.2 * greatest(0.0, 20 - snr) - 50 * clipping - 10 * greatest(0.0, silence - 0.3) - 0.1 * greatest(0.0, 20 - dynamic_range))) AS score, snr >= 15 AND clipping <= 0.01 AND silence <= 0.5 AND dynamic_range >= 10 AS passed FROM k)
    SELECT count(*) AS n_files, count(*) FILTER (passed) AS n_passed, count(*) FILTER (NOT passed) AS n_failed, round(avg(score), 6) AS mean_score FROM s""",
    ("clip",),
)
def validation_summary(spark, sf_dir):
    # the adapter's clips are short, at a low rate and off centre by nature: those three checks are left to audio_issues
    m = _metrics(spark, sf_dir).withColumns({"duration": F.lit(5.0), "sample_rate": F.lit(22050), "dc_offset": F.lit(0.0)})
    return _round(reports.validation_summary(m.select((F.size(quality.audio_issues()) == 0).alias("passed"), quality.file_score().alias("score"))), "mean_score")


@query(
    f"""+ {_METRICS} SELECT clip_id, concat_ws(',', 'too_short', 'low_sample_rate', CASE WHEN snr < 15 THEN 'low_snr' END, CASE WHEN clipping > 0.01 THEN 'clipping' END, CASE WHEN silence > 0.5 THEN 'silence' END,
      CASE WHEN dynamic_range < 10 THEN 'low_dynamic_range' END, CASE WHEN abs(dc_offset) > 0.01 THEN 'dc_offset' END) AS codes FROM k""",
    ("clip",),
)
def audio_issue_codes(spark, sf_dir):
    m = _metrics(spark, sf_dir).withColumn("duration", F.size("samples") / c("sample_rate"))
    return m.select("clip_id", F.array_join(quality.audio_issues(), ",").alias("codes"))


@query("SELECT count(*) AS segments, count(DISTINCT speaker) AS speakers, count(DISTINCT episode) AS episodes FROM seg", ("seg",))
def transcript_totals(spark, sf_dir):
    return reports.transcript_totals(adapters.segments(spark, sf_dir))


@query("SELECT count(*) AS n_files, round(sum(p_retailprice) / 60, 6) AS minutes, round(sum(p_partkey * 1000) / 1048576.0, 6)::DOUBLE AS megabytes, round(avg(p_retailprice) / 60, 6) AS mean_minutes FROM part")
def media_stats(spark, sf_dir):
    p = read(spark, sf_dir, "part").select(c("p_retailprice").alias("duration"), (c("p_partkey") * 1000).alias("file_size"))
    return _round(reports.media_stats(p), "minutes", "megabytes", "mean_minutes")


@query("SELECT count(*) AS n, count(*) FILTER (p_size % 2 = 0) AS n_denoised, count(*) FILTER (p_size % 3 = 0) AS n_limited, count(*) FILTER (p_size > 45) AS n_fry FROM part")
def enhancement_flags(spark, sf_dir):
    p = read(spark, sf_dir, "part").select((c("p_size") % 2 == 0).alias("denoised"), (c("p_size") % 3 == 0).alias("limited"), (c("p_size") > 45).alias("fry"))
    return reports.flag_counts(p, ["denoised", "limited", "fry"])


@query("SELECT episode, count(*) AS lines FROM utt GROUP BY episode", ("utt",))
def lines_per_episode(spark, sf_dir):
    return reports.lines_per_episode(adapters.utterances(spark, sf_dir))


@query("SELECT n_name AS label, count(*) AS n, string_agg('clips/' || s_suppkey, ',' ORDER BY s_suppkey) AS paths FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name")
def character_references(spark, sf_dir):
    s = read(spark, sf_dir, "supplier").join(F.broadcast(read(spark, sf_dir, "nation")), c("s_nationkey") == c("n_nationkey"))
    refs = s.select(c("n_name").alias("label"), F.concat(F.lit("clips/"), c("s_suppkey").cast("string")).alias("path"), c("s_suppkey").alias("ordinal"))
    return reports.references_of(refs).withColumn("paths", F.array_join("paths", ","))


@query("SELECT count(*) AS runs, round(sum(value), 6) AS total_seconds, round(avg(value), 6) AS mean_seconds FROM events WHERE event_type = 'view'")
def synthesis_latency(spark, sf_dir):
    return _round(reports.latency(read(spark, sf_dir, "events").where("event_type = 'view'"), "value"), "total_seconds", "mean_seconds")


@query("SELECT event_type AS name, min(value) AS lowest, arg_min(event_id, (value, event_id)) AS lowest_at, max(value) AS highest, arg_min(event_id, (-value, event_id)) AS highest_at, arg_max(value, event_id) AS last FROM events GROUP BY 1")
def best_metrics(spark, sf_dir):
    return reports.best_metrics(read(spark, sf_dir, "events").select(c("event_type").alias("name"), c("event_id").alias("step"), "value"))


@query("SELECT stage, string_agg(name || '=' || v, ',' ORDER BY name) AS metrics FROM (SELECT 'stage_' || (user_id % 5) AS stage, event_type AS name, arg_max(user_id, event_id) AS v FROM events GROUP BY 1, 2) GROUP BY stage")
def run_metrics(spark, sf_dir):
    e = read(spark, sf_dir, "events").select(F.concat(F.lit("stage_"), (c("user_id") % 5).cast("string")).alias("stage"), c("event_type").alias("name"), c("event_id").alias("step"), c("user_id").alias("value"))
    out = reports.run_metrics(e)
    return out.select("stage", F.array_join(F.transform(F.map_entries("metrics"), lambda x: F.concat_ws("=", x["key"], x["value"].cast("string"))), ",").alias("metrics"))


@query("+ s AS (SELECT speaker, sum(duration)::DOUBLE AS total_duration FROM vox GROUP BY speaker) SELECT *, row_number() OVER (ORDER BY total_duration DESC, speaker)::INTEGER AS place FROM s", ("vox",))
def clusters_by_duration(spark, sf_dir):
    stats = adapters.voices(spark, sf_dir).groupBy("speaker").agg(F.sum("duration").alias("total_duration"))
    return reports.by_duration(stats, "speaker")


_WORDS = r"len(list_filter(regexp_split_to_array(trim(text), '\s+'), lambda w: w <> ''))"


@query(f"+ q AS (SELECT *, ordinal % 10 / 10.0 AS confidence, ordinal * 7 % 30 AS quality, 1.0 + ordinal % 20 AS duration FROM utt) SELECT episode, ordinal FROM q WHERE duration BETWEEN 1.0 AND 15.0 AND confidence >= 0.2 AND quality >= 10.0 AND {_WORDS} >= 3", ("utt",))
def character_clips(spark, sf_dir):
    return _clip_rows(spark, sf_dir).where(clips.character_clips(RULES)).select("episode", "ordinal")


RULES = clips.ClipRules(min_confidence=0.2, min_snr=10.0)


def _clip_rows(spark, sf_dir):
    n = c("ordinal")
    return adapters.utterances(spark, sf_dir).withColumns({"confidence": n % 10 / 10.0, "quality": n * 7 % 30, "duration": F.lit(1.0) + n % 20})


_SPANS = """r AS (SELECT vec_id AS clip_id, list_transform(embedding, lambda x: x::DOUBLE) AS samples, 16 AS rate, vec_id % 5 * 0.75 AS s, 1.5 + vec_id % 7 * 0.5 AS e FROM embeddings),
    x AS (SELECT clip_id, samples, rate, greatest(0.0, s - 0.25) AS s, least(len(samples) / 16.0, e + 0.25) AS e FROM r)"""


@query(
    f"""WITH {_SPANS} SELECT clip_id, round(s, 6)::DOUBLE AS start, round(e, 6)::DOUBLE AS "end", floor(s * rate) < len(samples) AND floor(e * rate) <= len(samples) AS inside,
      greatest(0, floor(e * rate)::INTEGER - floor(s * rate)::INTEGER)::INTEGER AS n, round(coalesce(list_sum(samples[floor(s * rate)::INTEGER + 1 : floor(e * rate)::INTEGER]), 0.0), 6) AS total FROM x"""
)
def cut_clips(spark, sf_dir):
    v = read(spark, sf_dir, "embeddings").select(c("vec_id").alias("clip_id"), c("embedding").cast("array<double>").alias("samples"), (c("vec_id") % 5 * 0.75).alias("s"), (1.5 + c("vec_id") % 7 * 0.5).alias("e"))
    start, end = clips.extended(c("s"), c("e"), F.size("samples") / F.lit(16.0), 0.25, 1.0)
    rate = F.lit(16)
    x = v.select("clip_id", "samples", start.alias("start"), end.alias("end"))
    cut = x.withColumn("cut", clips.sample_slice(c("samples"), c("start"), c("end"), rate)).withColumn("inside", clips.within(c("start"), c("end"), rate, F.size("samples")))
    return cut.select("clip_id", F.round("start", 6).alias("start"), F.round("end", 6).alias("end"), "inside", F.size("cut").alias("n"), F.round(F.aggregate("cut", F.lit(0.0), lambda a, b: a + b), 6).alias("total"))


@query("SELECT vec_id AS clip_id, least(32, 20 + vec_id % 45)::INTEGER AS n, round(list_sum(list_transform(embedding[1 : least(32, 20 + vec_id % 45)], lambda x: x::DOUBLE)), 6) AS total FROM embeddings WHERE (20 + vec_id % 45) / 16.0 >= 1.5")
def embedding_input(spark, sf_dir):
    v = read(spark, sf_dir, "embeddings").select(c("vec_id").alias("clip_id"), F.slice(c("embedding").cast("array<double>"), F.lit(1), (20 + c("vec_id") % 45).cast("int")).alias("samples"), F.lit(16).alias("sample_rate"))
    out = clips.embedding_samples(v, 1.5, 2.0)
    return out.select("clip_id", F.size("samples").alias("n"), F.round(F.aggregate("samples", F.lit(0.0), lambda a, b: a + b), 6).alias("total"))


@query(
    """WITH r AS (SELECT vec_id::VARCHAR AS episode, list_transform(embedding, lambda x: x::DOUBLE) AS samples FROM embeddings),
    k AS (SELECT (event_id % 400)::VARCHAR AS episode, 'c' || (user_id % 3) AS character, event_id AS ordinal, (event_id % 13)::DOUBLE AS s, event_id % 13 + value AS e FROM events WHERE value >= 2.0),
    n AS (SELECT *, row_number() OVER (PARTITION BY episode, character ORDER BY s, ordinal)::INTEGER AS number FROM k)
    SELECT n.episode, character, number, ordinal, (floor(e * 4) - floor(s * 4))::INTEGER AS n, round(list_sum(list_transform(samples[floor(s * 4)::INTEGER + 1 : floor(e * 4)::INTEGER], lambda x, i: x * i)), 6) AS mark
    FROM n JOIN r ON r.episode = n.episode WHERE floor(s * 4) < len(samples) AND floor(e * 4) <= len(samples)"""
)
def extracted_clips(spark, sf_dir):
    recordings = read(spark, sf_dir, "embeddings").select(c("vec_id").cast("string").alias("episode"), c("embedding").cast("array<double>").alias("samples"), F.lit(4.0).alias("sample_rate"))
    start = (c("event_id") % 13).cast("double")
    kept = read(spark, sf_dir, "events").where("value >= 2.0").select((c("event_id") % 400).cast("string").alias("episode"), F.concat(F.lit("c"), (c("user_id") % 3).cast("string")).alias("character"), c("event_id").alias("ordinal"), start.alias("start"), (start + c("value")).alias("end"))
    out = clips.extract(kept, recordings)
    mark = F.aggregate(F.transform("samples", lambda x, i: x * (i + 1)), F.lit(0.0), lambda a, b: a + b)
    return out.select("episode", "character", "number", "ordinal", F.size("samples").alias("n"), F.round(mark, 6).alias("mark"))


def _files(spark, sf_dir):
    return read(spark, sf_dir, "documents").select(F.concat(F.lit("ep_"), c("doc_id").cast("string")).alias("stem"), "doc_id")


@query("SELECT d.doc_id, l.quality FROM documents d JOIN (SELECT doc_id, min(quality) AS quality FROM labels GROUP BY 1) l ON l.doc_id = d.doc_id")
def audio_with_transcript(spark, sf_dir):
    return _paired(spark, sf_dir)[0].select("doc_id", "quality")


def _paired(spark, sf_dir):
    labels = read(spark, sf_dir, "labels").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    return clips.with_transcript(_files(spark, sf_dir), labels.select(F.concat(F.lit("ep_"), c("doc_id").cast("string")).alias("stem"), "quality"))


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def audio_without_transcript(spark, sf_dir):
    return _paired(spark, sf_dir)[1].select("doc_id")


@query(
    """+ f AS (SELECT DISTINCT speaker, 'ep' || episode || '_' || vec_id || '.wav' AS name FROM vox), m AS (SELECT DISTINCT speaker, 'ep' || episode AS episode FROM vox WHERE episode::INT < 5)
    SELECT f.speaker, name, episode FROM f JOIN m ON f.speaker = m.speaker AND starts_with(name, episode)""",
    ("vox",),
)
def clips_of_mapping(spark, sf_dir):
    v = adapters.voices(spark, sf_dir).withColumn("episode", F.concat(F.lit("ep"), "episode"))
    files = v.select("speaker", F.concat_ws("", "episode", F.lit("_"), c("vec_id").cast("string"), F.lit(".wav")).alias("name")).distinct()
    return clips.clips_of_mapping(files, v.where("cast(substring(episode, 3) as int) < 5").select("speaker", "episode").distinct()).select("speaker", "name", "episode")


@query("SELECT o_orderkey, coalesce(c_name, 'unknown') AS label FROM orders LEFT JOIN (SELECT c_custkey, min(c_name) AS c_name FROM customer WHERE c_custkey % 3 = 0 GROUP BY 1) ON o_custkey = c_custkey")
def restored_labels(spark, sf_dir):
    known = read(spark, sf_dir, "customer").where("c_custkey % 3 = 0").select(c("c_custkey").alias("path"), c("c_name").alias("label"))
    return clips.restored_labels(read(spark, sf_dir, "orders").select("o_orderkey", c("o_custkey").alias("path")), known).select("o_orderkey", "label")


@query("SELECT doc_id FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def existing_references(spark, sf_dir):
    found, _ = clips.existing_references(read(spark, sf_dir, "documents").select(c("doc_id").alias("path")), read(spark, sf_dir, "labels").select(c("doc_id").alias("path")))
    return found.select(c("path").alias("doc_id"))


@query("SELECT 'in/ep' || episode || '/' || vec_id || '.wav' AS source, 'out/' || CASE speaker WHEN '0' THEN 'anna' ELSE 'ben' END || '/' || vec_id || '.wav' AS target FROM vox WHERE speaker IN ('0', '1')", ("vox",))
def copy_plan(spark, sf_dir):
    v = adapters.voices(spark, sf_dir).select(c("speaker").alias("cluster_id"), F.concat_ws("", F.lit("in/ep"), "episode", F.lit("/"), c("vec_id").cast("string"), F.lit(".wav")).alias("path"))
    return clips.copy_plan(v, spark.createDataFrame([("0", "anna"), ("1", "ben")], "cluster_id string, label string"), "out/")


@query("+ n AS (SELECT *, row_number() OVER (PARTITION BY speaker ORDER BY quality DESC, vec_id)::VARCHAR AS p FROM vox) SELECT vec_id, CASE WHEN len(p) < 2 THEN '0' || p ELSE p END || '_' || 'clip' || vec_id AS sample_name FROM n", ("vox",))
def numbered_samples(spark, sf_dir):
    v = adapters.voices(spark, sf_dir).withColumn("name", F.concat(F.lit("clip"), c("vec_id").cast("string")))
    return clips.numbered_samples(v, "speaker", [F.desc("quality"), "vec_id"], "name").select("vec_id", "sample_name")


@query("SELECT vec_id, round(coalesce(sum(duration + 0.3) OVER w, 0.0), 6) AS position, round(coalesce(sum(duration + 0.3) OVER w, 0.0) + duration, 6) AS position_end FROM vox WINDOW w AS (PARTITION BY speaker ORDER BY vec_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)", ("vox",))
def concatenation_positions(spark, sf_dir):
    return _round(clips.positions(adapters.voices(spark, sf_dir), "speaker", ["vec_id"]).select("vec_id", "position", "position_end"), "position", "position_end")


@query(
    """+ m AS (SELECT episode, 1000 - min(episode::INT) AS position FROM utt GROUP BY episode)
    SELECT utt.episode, ordinal, row_number() OVER (ORDER BY position, utt.episode, ordinal) AS place FROM utt JOIN m ON m.episode = utt.episode""",
    ("utt",),
)
def dialogue_order(spark, sf_dir):
    u = adapters.utterances(spark, sf_dir)
    mapping = u.select("episode", (1000 - c("episode").cast("int")).alias("position")).distinct()
    return clips.dialogue(u, mapping).select("episode", "ordinal", c("place").cast("long").alias("place"))


@query(
    """WITH f AS (SELECT s AS stem, CASE p_partkey % 7 WHEN 0 THEN s || '_(Vocals)_model.wav' WHEN 1 THEN s || '_Vocals.wav' WHEN 2 THEN 'mix ' || s || ' Vocals 2.wav' WHEN 3 THEN 'Vocals ' || s || '.wav' WHEN 4 THEN s || '_vocals.wav' WHEN 5 THEN s || '_(Vocals).flac' ELSE 'drums.wav' END AS name, 'p/' || p_partkey AS path FROM (SELECT p_partkey, 'rec' || (p_partkey // 4 % 90) AS s FROM part)),
    r AS (SELECT *, CASE WHEN name GLOB stem || '_(Vocals)*.wav' THEN 0 WHEN name GLOB stem || '_Vocals.wav' THEN 1 WHEN name GLOB '*' || stem || '*Vocals*.wav' THEN 2 WHEN name GLOB '*Vocals*.wav' THEN 3 END AS k FROM f)
    SELECT stem, arg_min(path, (k, path)) AS path FROM r WHERE k IS NOT NULL GROUP BY stem"""
)
def vocals_files(spark, sf_dir):
    stem, say = F.concat(F.lit("rec"), (F.floor(c("p_partkey") / 4) % 90).cast("string")), lambda *x: F.concat(*[F.lit(v) if isinstance(v, str) else v for v in x])
    kind, s = c("p_partkey") % 7, c("stem")
    names = [say(s, "_(Vocals)_model.wav"), say(s, "_Vocals.wav"), say("mix ", s, " Vocals 2.wav"), say("Vocals ", s, ".wav"), say(s, "_vocals.wav"), say(s, "_(Vocals).flac")]
    name = F.coalesce(*[F.when(kind == k, n) for k, n in enumerate(names)], F.lit("drums.wav"))
    f = read(spark, sf_dir, "part").withColumn("stem", stem).select("stem", name.alias("name"), say("p/", c("p_partkey").cast("string")).alias("path"))
    return clips.vocals_file(f)


@query("SELECT p_brand AS folder, min(p_name || p_partkey) AS path FROM part GROUP BY 1")
def first_reference(spark, sf_dir):
    f = read(spark, sf_dir, "part").select(c("p_brand").alias("folder"), F.concat("p_name", c("p_partkey").cast("string")).alias("path"))
    return clips.first_file(f, "folder")


@query(f"WITH {_SCORED} SELECT l_orderkey || '-' || l_linenumber AS clip, speaker, o_orderpriority AS text, duration, CASE WHEN ('0x' || sha256(l_orderkey || '-' || l_linenumber)[1:8])::BIGINT % 10 = 0 THEN 'val' ELSE 'train' END AS split FROM j JOIN orders ON o_orderkey = l_orderkey WHERE reason IS NULL AND trim(o_orderpriority) <> ''")
def dataset_manifest(spark, sf_dir):
    accepted = _scored(spark, sf_dir).where("reason is null").withColumn("clip", F.concat_ws("-", c("l_orderkey").cast("string"), c("l_linenumber").cast("string")))
    texts = accepted.select("clip", "l_orderkey").join(read(spark, sf_dir, "orders"), c("l_orderkey") == c("o_orderkey")).groupBy("clip").agg(F.min("o_orderpriority").alias("text"))
    return clips.dataset_manifest(accepted, texts)


@query(
    """+ e AS (SELECT DISTINCT episode, 80000.0 AS total FROM seg), g AS (SELECT s.episode, count(*) AS n, count(*) FILTER (s."start" >= 0 AND s."start" < s."end" AND s."end" <= total AND trim(s.text) <> '') AS n_good FROM seg s JOIN e ON e.episode = s.episode GROUP BY 1)
    SELECT episode, n, n_good, round(n_good::DOUBLE / n, 6) AS share, round(10 * n_good::DOUBLE / n, 6) AS score FROM g""",
    ("seg",),
)
def transcript_alignment(spark, sf_dir):
    seg = adapters.segments(spark, sf_dir)
    return _round(clips.transcript_alignment(seg, seg.select("episode").distinct().withColumn("total", F.lit(80000.0))), "share", "score")


@query(
    r"""WITH s AS (SELECT conv_id, turn, text, role || '-' || turn || CASE (conv_id + turn) % 6 WHEN 0 THEN '.wav' WHEN 1 THEN '.MP3' WHEN 2 THEN '.txt' WHEN 3 THEN '.tar.flac' WHEN 4 THEN 'wav' ELSE '.Ogg' END AS name FROM conversations)
    SELECT conv_id, turn, left(text, 50) || CASE WHEN len(text) > 50 THEN '...' ELSE '' END AS quote, regexp_matches(lower(name), '\.(wav|mp3|flac|ogg)$') AS attachment FROM s"""
)
def quotations(spark, sf_dir):
    kind = (c("conv_id") + c("turn")) % 6
    ending = F.coalesce(*[F.when(kind == k, e) for k, e in enumerate((".wav", ".MP3", ".txt", ".tar.flac", "wav"))], F.lit(".Ogg"))
    name = F.concat("role", F.lit("-"), c("turn").cast("string"), ending)
    return read(spark, sf_dir, "conversations").select("conv_id", "turn", clips.shortened(c("text")).alias("quote"), clips.is_audio_attachment(name).alias("attachment"))


@query("SELECT event_id, try_cast(x AS DOUBLE) AS number, CASE WHEN try_cast(x AS DOUBLE) IS NULL THEN 'not a number: ' || x END AS error FROM (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN event_type ELSE value::VARCHAR END AS x FROM events)")
def rescued_rows(spark, sf_dir):
    e = read(spark, sf_dir, "events").select("event_id", F.when(c("event_id") % 7 == 0, c("event_type")).otherwise(c("value").cast("string")).alias("x"))
    return clips.rated(e, "x").select("event_id", "number", "error")


@query("SELECT l_orderkey, l_linenumber, round(CASE WHEN l_quantity % 5 = 0 THEN 0.0 ELSE l_extendedprice / (l_quantity % 5) END, 6) AS rate FROM lineitem")
def real_time_rates(spark, sf_dir):
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.round(clips.real_time_rate(c("l_extendedprice"), c("l_quantity") % 5), 6).alias("rate"))


_TOTALS = ("peak", "rms", "lufs", "segment", "faded", "limited", "padded", "mixed", "joined")


@query(
    """+ m AS (SELECT clip_id, samples AS s, list_max(list_transform(samples, lambda x: abs(x))) AS p, sqrt(list_sum(list_transform(samples, lambda x: x * x)) / len(samples)) AS r, list_avg(samples) AS d FROM clip),
    t AS (SELECT clip_id, s, list_transform(s, lambda x: greatest(-1.0, least(1.0, x * (pow(10.0, -23.0 / 20) / p)))) AS peak, list_transform(s, lambda x: greatest(-1.0, least(1.0, x * (0.1 / r)))) AS rms, list_transform(s, lambda x: greatest(-1.0, least(1.0, x * (pow(10.0, -3.0 / 20) / r)))) AS lufs,
      list_transform(s, lambda x: x * (0.95 / p)) AS segment, list_transform(s, lambda x, i: x * CASE WHEN i - 1 < 5 THEN (i - 1) / 4.0 ELSE 1.0 END * CASE WHEN i - 1 >= len(s) - 4 THEN (len(s) - i) / 3.0 ELSE 1.0 END) AS faded,
      list_transform(s, lambda x: greatest(-1.0, least(1.0, (exp(2 * (x - d) * 0.95) - 1) / (exp(2 * (x - d) * 0.95) + 1) * 0.95))) AS limited FROM m),
    q AS (SELECT clip_id, unnest(['peak', 'rms', 'lufs', 'segment', 'faded', 'limited', 'padded', 'mixed', 'joined']) AS kind, unnest([peak, rms, lufs, segment, faded, limited, s[1:50], list_transform(s[1:40], lambda x, i: (x + s[i + 10]) / 2), list_concat(s, s[1:10])]) AS x FROM t)
    SELECT clip_id, kind, round(list_sum(list_transform(x, lambda v, i: v * (i % 7 + 1))), 5) AS mark FROM q WHERE kind <> 'joined' UNION ALL
    SELECT clip_id, kind, round(list_sum(list_transform(x, lambda v, i: v * (CASE WHEN i > 64 THEN i + 6 ELSE i END % 7 + 1))), 5) FROM q WHERE kind = 'joined'""",
    ("clip",),
)
def waveform_transforms(spark, sf_dir):
    s = c("samples")
    made = {
        "peak": S.normalise(s, "peak"), "rms": S.normalise(s, "rms"), "lufs": S.normalise(s, "lufs"), "segment": S.to_peak(s), "faded": S.fade(s, 5, 4), "limited": S.soft_limit(s),
        "padded": S.to_length(F.slice(s, 1, 50), F.lit(70)), "mixed": S.mono(F.slice(s, 1, 40), F.slice(s, 11, 54)), "joined": S.joined_with_gaps(F.array(s, F.slice(s, 1, 10)), 6),
    }
    x = adapters.clips(spark, sf_dir)
    parts = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), made[k].alias("x")) for k in _TOTALS]))
    mark = F.aggregate(F.transform("p.x", lambda v, i: v * ((i + 1) % 7 + 1)), F.lit(0.0), lambda a, b: a + b)
    return x.select("clip_id", parts.alias("p")).select("clip_id", "p.kind", F.round(mark, 5).alias("mark"))


@query(f"+ {_METRICS} SELECT clip_id, round(CASE WHEN clip_id % 4 = 0 THEN 0.0 ELSE snr END, 6) AS segment_snr, round(CASE WHEN clip_id % 4 = 1 THEN 20.0 WHEN clip_id % 4 = 0 THEN 60.0 ELSE snr END, 6) AS enhanced_snr FROM k", ("clip",))
def snr_variants(spark, sf_dir):
    x = adapters.clips(spark, sf_dir)
    kind = c("clip_id") % 4
    silent = F.transform("samples", lambda v: v * 0)
    return x.select("clip_id", F.round(S.snr_of_segment(F.when(kind == 0, silent).otherwise(c("samples"))), 6).alias("segment_snr"), F.round(S.snr_after_enhancement(F.when(kind == 1, F.array().cast("array<double>")).when(kind == 0, silent).otherwise(c("samples"))), 6).alias("enhanced_snr"))


@query(
    r"""+ n AS (SELECT vec_id, 'ep' || episode || '_' || speaker || '_' || vec_id || CASE WHEN vec_id % 3 = 0 THEN '_processed.wav' ELSE '.wav' END AS name FROM vox)
    SELECT vec_id, 'ep' || split_part(name, '_', 1)[3:] AS episode, (vec_id % 60)::DOUBLE / CASE WHEN vec_id % 5 = 0 THEN 1 ELSE vec_id % 5 END * CASE WHEN vec_id % 5 = 0 THEN 0 ELSE 1 END AS fps, 'A_b-' || vec_id AS archive FROM n""",
    ("vox",),
)
def name_parts(spark, sf_dir):
    v = adapters.voices(spark, sf_dir)
    tail = F.when(c("vec_id") % 3 == 0, "_processed.wav").otherwise(".wav")
    name = F.concat_ws("", F.lit("ep"), "episode", F.lit("_"), "speaker", F.lit("_"), c("vec_id").cast("string"), tail)
    ratio = F.concat_ws("/", (c("vec_id") % 60).cast("string"), (c("vec_id") % 5).cast("string"))
    return v.select("vec_id", T.episode_of_clip(name).alias("episode"), T.frame_rate(ratio).alias("fps"), T.archive_name(F.concat(F.lit("A b-!?"), c("vec_id").cast("string"), F.lit("  "))).alias("archive"))


@query()
def spectral_measures(spark, sf_dir):
    x, rate = adapters.clips(spark, sf_dir), c("sample_rate")
    total = lambda a: F.round(F.aggregate(F.transform(a, lambda v: v * v), F.lit(0.0), lambda p, q: p + q), 5)
    m = x.select("clip_id", spectral.has_fry(c("samples"), rate).alias("fry"), spectral.less_fry(c("samples"), rate).alias("less"), spectral.more_speech(c("samples"), rate).alias("more"), spectral.trim_silence(c("samples"), rate).alias("trimmed"))
    return m.select("clip_id", "fry", total(c("less")).alias("less_power"), total(c("more")).alias("more_power"), F.size("trimmed").alias("n_trimmed"))
