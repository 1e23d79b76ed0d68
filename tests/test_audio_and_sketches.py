import io
import os
import random
import struct
import wave

import pytest
from pyspark.sql import functions as F

from veilcorpus.functions.audio import header_length
from veilcorpus.operators import chat, sketches
from veilcorpus.sources import readers, writers


def wav(seconds, rate=8000, extra=b""):
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(2), w.setsampwidth(2), w.setframerate(rate)
        w.writeframes(b"\0" * int(seconds * rate) * 4)
    data = out.getvalue()
    return data[:12] + extra + data[12:]


def flac(samples, rate=44100):
    packed = (rate << 44) | (1 << 41) | (15 << 36) | samples
    return b"fLaC" + b"\x80\0\0\x22" + b"\0" * 10 + packed.to_bytes(8, "big") + b"\0" * 16 + b"frames"


CASES = {
    "one.wav": (wav(1.5), 1.5, "ok"), "listed.wav": (wav(2, extra=b"LIST" + struct.pack("<I", 3) + b"abc\0"), 2.0, "ok"),
    "a.flac": (flac(44100 * 3), 3.0, "ok"), "none.wav": (b"", None, "empty"), "text.mp3": (b"ID3 not known", None, "unknown format"),
    "cut.wav": (wav(1)[:30], None, "broken header"), "cut.flac": (flac(10)[:20], None, "broken header"),
    "zero.flac": (flac(0), None, "broken header"), "riff.avi": (b"RIFF\0\0\0\0AVI ", None, "unknown format"),
    "late.wav": (b"RIFF\0\0\0\0WAVEdata\0\0\0\0", None, "broken header"),
}


def test_lengths_from_heads():
    for name, (data, seconds, status) in CASES.items():
        assert header_length(io.BytesIO(data)) == (seconds, status), name


def test_only_named_files_are_read(spark, tmp_path, capsys):
    folder = tmp_path / "audio's"
    for name, (data, _, _) in CASES.items():
        path = folder / ("sub" if name == "a.flac" else "") / name
        os.makedirs(path.parent, exist_ok=True)
        path.write_bytes(data)
    unread = folder / "unread.wav"
    unread.write_bytes(wav(1))
    os.chmod(unread, 0)
    names = ["one.wav", "./listed.wav", "sub/a.flac", "none.wav", "cut.wav", "gone.wav", "one.wav", "text.mp3"]
    wanted = spark.createDataFrame([(n, f"says {i}") for i, n in enumerate(names)] + [(None, "no path")], "path string, transcription string")
    rows = readers.read_audio_folder(spark, f"file://{folder}", wanted, max_seconds=2.5)
    got = {r["transcription"]: (r["seconds"], r["status"] if r["status"] != "ok" else r["head"], r["audio"] and bytes(r["audio"]["bytes"])) for r in rows.collect()}
    assert got == {
        "says 0": (1.5, "ok", CASES["one.wav"][0]), "says 1": (2.0, "ok", CASES["listed.wav"][0]), "says 2": (3.0, "too long", None),
        "says 3": (None, "missing", None), "says 4": (None, "broken header", CASES["cut.wav"][0]), "says 5": (None, "missing", None),
        "says 6": (1.5, "ok", CASES["one.wav"][0]), "says 7": (None, "unknown format", CASES["text.mp3"][0]), "no path": (None, "missing", None),
    }
    rows.explain()
    plan = capsys.readouterr().out
    assert "binaryFile" in plan and "content" not in plan.split("binaryFile")[0].split("\n")[-1]
    usable = rows.filter(chat.usable_audio(F.col("transcription"), F.col("audio")))
    assert usable.filter("status = 'ok' AND head = 'ok'").count() == 3
    assert chat.within_context(rows, F.col("seconds"), 1.7).count() == 2
    assert readers.read_audio_folder(spark, f"file://{folder}", wanted.limit(0)).count() == 0
    held = spark.createDataFrame([(d,) for d, _, _ in CASES.values()] + [(None,)], "a binary")
    found = [tuple(r["x"]) for r in held.select(readers.audio_seconds(F.col("a")).alias("x")).collect()]
    assert found == [(s, status) for _, s, status in CASES.values()] + [(None, "missing")]


def test_many_runs_make_few_folders(spark, tmp_path):
    path = f"{tmp_path}/s"
    values = spark.range(600).select((F.col("id") % 300).cast("string").alias("run_id"), F.col("id").cast("double").alias("value"))
    none = values.limit(1).withColumn("run_id", F.lit(None).cast("string"))
    writers.save_sketches(sketches.value_sketches(values.unionByName(none), ["run_id"]), path)
    writers.save_sketches(sketches.value_sketches(values.filter("run_id IN ('7', '8')").limit(3).unionByName(none), ["run_id"]), path)
    held = {r["run_id"]: r["n"] for r in readers.read_sketches(spark, path).collect()}
    assert len(held) == 301 == readers.read_sketches(spark, path).count() and held[None] == 1
    assert held["7"] + held["8"] == 3 and sum(held.values()) == 298 * 2 + 3 + 1
    assert sum(n.startswith("bucket=") for n in os.listdir(path)) <= writers.SKETCH_FOLDERS


def test_merged_sketches_are_as_good_as_one(spark, tmp_path):
    rng = random.Random(2)
    values = [rng.lognormvariate(0, 2) for _ in range(20_000)] + [5.0] * 10_000  # a third of all values are one
    rows = [(f"run {i % 7}", v) for i, v in enumerate(values)] + [("run 0", None), ("null", None)]
    df = spark.createDataFrame(rows, "run_id string, latency_s double").repartition(6)
    parts = sketches.latency_sketches(df, F.col("run_id"))
    for _ in range(2):
        writers.save_sketches(parts, f"{tmp_path}/s")
    stored = readers.read_sketches(spark, f"{tmp_path}/s")
    assert stored.count() == 8 and stored.agg(F.sum("n")).first()[0] == len(values)
    whole = sketches.merge_sketches(sketches.value_sketches(df, [], "latency_s"))
    values.sort()
    for table in (whole, sketches.merge_sketches(stored)):
        got = table.select("n", *[sketches.quantile(F.col("sketch"), p / 20).alias(f"q{p}") for p in range(21)]).first()
        assert got["n"] == len(values) and (got["q0"], got["q20"]) == (values[0], values[-1])
        for p in range(1, 20):
            below = sum(v < got[f"q{p}"] for v in values) / len(values)
            upto = sum(v <= got[f"q{p}"] for v in values) / len(values)
            assert below - 2 * sketches.RANK_ERROR <= p / 20 <= upto + 2 * sketches.RANK_ERROR
    assert sketches.merge_sketches(stored, ["run_id"]).count() == 7
    assert sketches.merge_sketches(stored.limit(0), ["run_id"]).count() == 0
