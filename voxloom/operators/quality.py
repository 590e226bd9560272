"""Acceptance of clips: scores, first failing rule, reports."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.functions.numbers import fixed, percent


@dataclass(frozen=True)
class AcceptRules:
    min_duration: float = 2.0
    max_duration: float = 15.0
    min_snr: float = 12.0
    min_speech: float = 0.5
    min_words: int = 3
    min_score: float = 0.5


@dataclass(frozen=True)
class MediaRules:
    min_seconds: float = 10.0
    max_seconds: float = 3600.0
    min_bytes: int = 1 << 20
    min_rate: int = 16000


def quality_score(duration: Column, snr: Column, speech: Column, words: Column, stable: Column, complete: Column) -> Column:
    """Weighted score of a clip, 0 to 1."""
    length = F.when(duration < 1, 0.0).when(duration < 2, 0.3).when(duration <= 8, 1.0).when(duration <= 15, 0.8).otherwise(0.4)
    loud = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (snr - 8) / 20))
    return 0.25 * length + 0.25 * loud + 0.2 * speech + 0.15 * F.least(F.lit(1.0), words / 5) + 0.05 * stable + 0.1 * F.when(complete, 1.0).otherwise(0.4)


def reason(rules: AcceptRules = AcceptRules()) -> Column:
    """Code of the first rule a clip fails; null if it is accepted."""
    c = F.col
    return (
        F.when(c("duration") < rules.min_duration, "too_short")
        .when(c("duration") > rules.max_duration, "too_long")
        .when(c("snr") < rules.min_snr, "low_snr")
        .when(c("speech_ratio") < rules.min_speech, "low_speech_ratio")
        .when(c("word_count") < rules.min_words, "too_few_words")
        .when(~c("complete"), "incomplete_words")
        .when(c("quality") < rules.min_score, "low_quality")
    )


def reason_message(rules: AcceptRules = AcceptRules()) -> Column:
    """The first rule a clip fails, in words, with its numbers; null if it is accepted. Wordings are fixed values."""
    c, say = F.col, lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    words = {
        "too_short": say("Too short: ", fixed(c("duration"), 1), f"s < {rules.min_duration}s"),
        "too_long": say("Too long: ", fixed(c("duration"), 1), f"s > {rules.max_duration}s"),
        "low_snr": say("Low SNR: ", fixed(c("snr"), 1), f"dB < {rules.min_snr}dB"),
        "low_speech_ratio": say("Low speech ratio: ", fixed(c("speech_ratio"), 2), f" < {rules.min_speech}"),
        "too_few_words": say("Too few words: ", c("word_count").cast("string"), f" < {rules.min_words}"),
        "incomplete_words": F.lit("Incomplete words/phrases"),
        "low_quality": say("Low quality score: ", fixed(c("quality"), 2), f" < {rules.min_score}"),
    }
    return _worded(reason(rules), words)


def _worded(code: Column, words: dict[str, Column]) -> Column:
    return F.coalesce(*[F.when(code == k, w) for k, w in words.items()])


def speaker_report(clips: DataFrame) -> DataFrame:
    """Per speaker: input, accepted, rejected, rate, accepted seconds and mean quality (0 if none)."""
    ok = F.col("reason").isNull()
    return clips.groupBy("speaker").agg(
        F.count("*").alias("n_input"),
        F.count_if(ok).alias("n_accepted"),
        F.count_if(~ok).alias("n_rejected"),
        (F.count_if(ok) / F.count("*")).alias("acceptance_rate"),
        F.coalesce(F.sum(F.when(ok, F.col("duration"))), F.lit(0.0)).alias("accepted_seconds"),
        F.coalesce(F.avg(F.when(ok, F.col("quality"))), F.lit(0.0)).alias("mean_quality"),
    )


def overall_report(by_speaker: DataFrame) -> DataFrame:
    """One row over speaker_report: sums, rate, hours and the unweighted mean of speaker means."""
    return by_speaker.agg(
        F.count("*").alias("speakers"),
        F.sum("n_input").alias("n_input"),
        F.sum("n_accepted").alias("n_accepted"),
        F.coalesce(F.try_divide(F.sum("n_accepted").cast("double"), F.sum("n_input")), F.lit(0.0)).alias("acceptance_rate"),
        (F.sum("accepted_seconds") / 3600).alias("hours"),
        F.avg("mean_quality").alias("mean_quality"),
    )


def reasons(clips: DataFrame) -> DataFrame:
    return clips.where("reason is not null").groupBy("reason").agg(F.count("*").alias("n"))


def media_reason(rules: MediaRules = MediaRules()) -> Column:
    """First failing rule of container metadata (duration, has_audio, file_size, rate); null if valid."""
    c = F.col
    return (
        F.when(c("duration") < rules.min_seconds, "too_short")
        .when(c("duration") > rules.max_seconds, "too_long")
        .when(~c("has_audio"), "no_audio")
        .when(c("file_size") < rules.min_bytes, "too_small")
        .when((c("rate") > 0) & (c("rate") < rules.min_rate), "low_rate")
    )


def audio_issues(low: float = 1.0, high: float = 30.0, least_snr: float = 15.0) -> Column:
    """All failed checks of a waveform's metrics, not the first only."""
    c = F.col
    checks = [
        F.when(c("duration") < low, "too_short").when(c("duration") > high, "too_long"),
        F.when(c("sample_rate") < 16000, "low_sample_rate"),
        F.when(c("snr") < least_snr, "low_snr"),
        F.when(c("clipping") > 0.01, "clipping"),
        F.when(c("silence") > 0.5, "silence"),
        F.when(c("dynamic_range") < 10, "low_dynamic_range"),
        F.when(F.abs(c("dc_offset")) > 0.01, "dc_offset"),
    ]
    return F.filter(F.array(*checks), lambda x: x.isNotNull())


def issue_messages(low: float = 1.0, high: float = 30.0, least_snr: float = 15) -> Column:
    """audio_issues in words, with their numbers. Wordings are fixed values; limits are written as they are given."""
    c, say = F.col, lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    words = {
        "too_short": say("Too short: ", fixed(c("duration"), 2), f"s (min: {low}s)"),
        "too_long": say("Too long: ", fixed(c("duration"), 2), f"s (max: {high}s)"),
        "low_sample_rate": say("Sample rate too low: ", c("sample_rate").cast("string"), "Hz (min: 16000Hz)"),
        "low_snr": say("Low SNR: ", fixed(c("snr"), 1), f"dB (min: {least_snr}dB)"),
        "clipping": say("Clipping detected: ", percent(c("clipping"), 2), " of samples"),
        "silence": say("Too much silence: ", percent(c("silence"), 1)),
        "low_dynamic_range": say("Low dynamic range: ", fixed(c("dynamic_range"), 1), "dB"),
        "dc_offset": say("DC offset detected: ", fixed(c("dc_offset"), 3)),
    }
    return F.transform(audio_issues(low, high, least_snr), lambda code: _worded(code, words))


def file_score() -> Column:
    """0 to 10; a missing metric counts as good."""
    miss = lambda x: F.greatest(F.lit(0.0), x)
    s = 10.0 - 0.2 * miss(20 - F.coalesce("snr", F.lit(20.0))) - 50 * F.coalesce("clipping", F.lit(0.0)) - 10 * miss(F.coalesce("silence", F.lit(0.0)) - 0.3) - 0.1 * miss(20 - F.coalesce("dynamic_range", F.lit(20.0)))
    return F.greatest(F.lit(0.0), F.least(F.lit(10.0), s))
