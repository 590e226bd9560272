"""Documents written over several files are, read in order, the bytes of one composed in Python."""

import random

import pytest

from voxloom.operators import documents

CLUSTERS = "cluster_id int, label string, total_duration double, speakers array<string>, n_episodes int, segments int, quality double"
SAID = "cluster_id int, episode string, position int, time double, speaker string, text string"


def some():
    rng = random.Random(2)
    clusters = [(k, None if k == 2 else f"name {k}", d, ["S2", "S1"], k + 1, 10 * k, 0.25 * k if k else None) for k, d in enumerate([15.0, 3.0, 59.97, 123456.0, 0.0])]
    # the place of an episode isn't that of its name
    said = [(k, f"ep{e}", 20 - e, t / 4, rng.choice(["S1", "S2"]), rng.choice(["hé", " padded ", "two\nlines", 'a "quote"', "", "  ", None])) for k in (0, 1, 3) for e in range(12) for t in rng.sample(range(30000), 25)]
    return clusters, said


def composed(cluster, said):
    k, label, duration, speakers, episodes, _, _ = cluster
    out = f"FULL TRANSCRIPT - Cluster {k}\nCharacter: {label or 'unassigned'}\nTotal Duration: {duration / 60:.1f} minutes\nOriginal Speakers: {', '.join(sorted(speakers))}\nEpisodes: {episodes}\n{'=' * 60}\n\n"
    rows = sorted((p, e, t, s, x.strip()) for c, e, p, t, s, x in said if c == k and x and x.strip())
    if not rows:
        return out + "No dialogue found for this cluster.\n"
    now, counts = None, {}
    for _, e, t, s, x in rows:
        if e != now:
            out += f"\n--- {e} ---\n\n"
            now = e
        out += f'[{int(t // 60):02d}:{int(t % 60):02d}] {s}: "{x}"\n'
        counts[e] = counts.get(e, 0) + 1
    return out + f"\n{'=' * 60}\nSUMMARY:\nTotal lines: {len(rows)}\nLines by episode:\n" + "".join(f"  {e}: {n} lines\n" for e, n in sorted(counts.items()))


@pytest.mark.parametrize("parts", [1, 9])
def test_transcripts(spark, tmp_path, parts):
    clusters, said = some()
    lines = documents.transcript_lines(spark.createDataFrame(clusters, CLUSTERS), spark.createDataFrame(said, SAID).repartition(5))
    documents.write_documents(lines, f"{tmp_path}/docs", parts)
    for cluster in clusters:
        assert documents.read_document(spark, f"{tmp_path}/docs", cluster[0]).decode() == composed(cluster, said)
    files = [len(documents.document_files(spark, f"{tmp_path}/docs", k)) for k in (0, 1, 3)]
    assert max(files) == 1 if parts == 1 else max(files) > 1


def test_cluster_info(spark, tmp_path):
    clusters, said = some()
    first = spark.createDataFrame(said, SAID).select("cluster_id", "episode", "position").distinct()
    documents.write_documents(documents.info_lines(spark.createDataFrame(clusters, CLUSTERS), first), f"{tmp_path}/info", 1)
    want = "Cluster ID: 3\nCharacter: name 3\nDuration: 2057.6 minutes\nEpisodes: 4\nSegments: 30\nQuality Score: 0.75\nOriginal Speakers: S1, S2\n\nFirst few episodes:\n  - ep11\n  - ep10\n  - ep9\n  - ep8\n  - ep7\n"
    assert documents.read_document(spark, f"{tmp_path}/info", 3).decode() == want
    assert "Quality Score: N/A\n" in documents.read_document(spark, f"{tmp_path}/info", 0).decode()
    assert documents.read_document(spark, f"{tmp_path}/info", 2).decode().endswith("First few episodes:\n")


def test_nothing_said(spark):
    clusters, _ = some()
    none = spark.createDataFrame([], SAID)
    lines = documents.transcript_lines(spark.createDataFrame(clusters, CLUSTERS), none)
    assert lines.where(f"line = '{documents.NONE}'").count() == len(clusters)
    assert documents.transcript_lines(spark.createDataFrame([], CLUSTERS), none).count() == 0
