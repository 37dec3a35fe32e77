"""The message folder as a stream: limit per trigger, restarts, replay."""

import time

from weftline.sources.queue import MessageFolderReader, stream_message_folder


def test_every_message_once_across_restarts(spark, tmp_path):
    queue, checkpoint = tmp_path / "queue", tmp_path / "checkpoint"
    queue.mkdir()
    put = lambda *numbers: [(queue / f"{n:06d}.json").write_text(f'{{"n": {n}, "é": "x"}}') for n in numbers]
    put(*range(10))
    (queue / "_hidden").write_text("no message")
    seen: dict[int, list[str]] = {}

    def take(batch, batch_id):
        seen[batch_id] = sorted(r["message_id"] for r in batch.collect())

    def start():
        stream = stream_message_folder(spark, str(queue), str(checkpoint), per_trigger=4)
        return stream.writeStream.foreachBatch(take).option("checkpointLocation", str(checkpoint)).trigger(processingTime="0 seconds").start()

    query = start()
    query.processAllAvailable()
    query.stop()
    assert [len(seen[k]) for k in sorted(seen)] == [4, 4, 2]
    put(*range(10, 21))
    query = start()
    until = time.monotonic() + 60
    while len(seen) < 5 and time.monotonic() < until:
        time.sleep(0.05)
    # Stopped somewhere in the middle and started again.
    query.stop()
    query = start()
    query.processAllAvailable()
    query.stop()
    assert all(len(names) <= 4 for names in seen.values())
    assert sorted(n for names in seen.values() for n in names) == [f"{n:06d}.json" for n in range(21)]


def test_a_replayed_batch_reads_the_same(tmp_path):
    queue = tmp_path / "queue"
    queue.mkdir()
    for n in range(5):
        (queue / f"{n}").write_text(str(n))
    progress = str(tmp_path / "checkpoint" / "at.json")
    first = MessageFolderReader(str(queue), progress, 2)
    begin = first.initialOffset()
    end = first.latestOffset()
    plan = lambda r: [b.column("body")[0].as_py() for p in r.partitions(begin, end) for b in r.read(p)]
    assert plan(first) == ["0", "1"] and first.latestOffset() == {"after": "3"}
    (queue / "5").write_text("5")
    again = MessageFolderReader(str(queue), progress, 2)
    assert plan(again) == ["0", "1"] and again.latestOffset() == {"after": "3"}
    # Without its file the place is unknown: everything is offered, never less than was taken.
    (tmp_path / "none" / "offsets").mkdir(parents=True)
    (tmp_path / "none" / "offsets" / "0").write_text("")
    lost = MessageFolderReader(str(queue), str(tmp_path / "none" / "at.json"), 2)
    assert lost.latestOffset() == {"after": "5"}
