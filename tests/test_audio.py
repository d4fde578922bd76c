"""Audio is handed on in pieces of bounded size."""

from quire.operators import audio


def test_calls_hold_a_bounded_amount_of_audio(spark, monkeypatch):
    sizes, total = [], 40
    rows = spark.createDataFrame([(i, "ab" * (i % 3), "none" if i % 7 == 3 else "v", "0%") for i in range(total)], "id long, text string, voice string, rate string").coalesce(1)
    made = []

    def call(text, voice, rate):
        if voice == "none":
            raise ValueError("no voice")
        return bytes(1000 * len(text))

    done = audio.called(rows, call, len)
    got = {r.id: (r.text, r.voice, r.rate, None if r.audio is None else len(r.audio), r.duration_ms, r.error) for r in done.collect()}
    for i in range(total):
        text, n = "ab" * (i % 3), 2000 * (i % 3)
        want = (None, None, "ValueError: no voice") if i % 7 == 3 else (n, n, None) if n else (None, None, "ValueError: no valid audio")
        assert got[i] == (text, "none" if i % 7 == 3 else "v", "0%", *want)

    # the operator's own function, on one batch: it yields more than once before it has called for every row
    class Frame:
        columns, schema, sparkSession = rows.columns, rows.schema, spark

        def mapInArrow(self, run, schema):
            made.append(run)

    import pyarrow as pa

    monkeypatch.setattr(audio, "HELD", 5000)
    audio.called(Frame(), lambda text, voice, rate: sizes.append(1) or bytes(1000 * len(text)), len)
    batch = pa.RecordBatch.from_pylist([{"id": i, "text": "ab", "voice": "v", "rate": "0%"} for i in range(total)])
    pieces, called = [], []
    for piece in made[0](iter([batch])):
        pieces.append(piece)
        called.append(len(sizes))
    assert called[0] == 3 and max(p.num_rows for p in pieces) == 3
    assert [x for p in pieces for x in p["id"].to_pylist()] == list(range(total))
