"""The store's connector is not here; what would be written to it is checked at the writer."""

from helpers import topic
from millrace.sources import keyed_store
from millrace.sources.topics import Topic, append_topic
from millrace.streaming import runners

ROW = '{"user_id":"u","domain":"d","created_at":"2026-05-01T10:00:00Z","page_title":"%s"}'


def test_last_write_of_a_key_goes_to_the_store(spark, tmp_path, monkeypatch):
    source = Topic("processed", path=str(tmp_path / "processed"))
    append_topic(topic(spark, [ROW % "old", ROW % "new", "bad"], "processed"), source)
    written = []
    monkeypatch.setattr(keyed_store, "append_rows", lambda rows, *place: written.append((rows.collect(), place)))
    stream = keyed_store.store_stream(spark, source, "space", "edits")
    runners.start(stream, "store", str(tmp_path / "checkpoints"), until_caught_up=True).awaitTermination()
    ((rows, place),) = written
    assert place == ("space", "edits")
    assert [(r.user_id, r.domain, r.page_title) for r in rows] == [("u", "d", "new")]
    assert rows[0].asDict().keys() == {"user_id", "domain", "created_at", "page_title"}
