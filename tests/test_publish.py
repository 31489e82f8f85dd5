from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from furrow.operators import publishing, validate as va
from furrow.plans import onboard, publish as pub
from furrow.sources.sinks import latest, read_ledger

PAD = " The field should be looked at again before the end of the week by whoever works on it."


@pytest.fixture(scope="module")
def make(spark, lexicon, settings, make_pages):
    def build(documents):
        return onboard.catalogue(onboard.extract(make_pages(documents), lexicon, settings), lexicon, settings)

    return build


@pytest.fixture(scope="module")
def first(make):
    return make({"alphaland.pdf": ["Alphaland. Lentil stands well." + PAD, "Rain over Lakeside." + PAD]})


def test_publish_keeps_round_trips_and_records(spark, lexicon, settings, make, first, tmp_path):
    where = {"table": str(tmp_path / "node"), "ledger": str(tmp_path / "ledger")}
    one = pub.publish(spark, first, lexicon, settings, **where)
    assert one.status == "ACCEPTED" and one.round_trip_ok and one.changed is None and one.payload_bytes > 500
    two = pub.publish(spark, first, lexicon, settings, **where)
    assert two.changed is False and two.claims_hash == one.claims_hash and two.held.count() == first.count()
    more = make({"alphaland.pdf": ["Alphaland. Tomato and onion." + PAD]})
    three = pub.publish(spark, more, lexicon, settings, **where)
    assert three.changed is True
    assert three.held.count() == first.count() + more.count()  # nothing is deleted
    four = pub.publish(spark, more, lexicon, settings, pruned=True, **where)
    assert four.held.count() == more.count()
    entries = sorted(read_ledger(spark, where["ledger"]).collect(), key=lambda r: r["seq"])
    assert [e["changed_since_previous"] for e in entries] == [None, False, True, False]
    assert latest(spark, where["table"]).count() == more.count()


def test_ledger_keeps_the_newest(spark, lexicon, settings, first, tmp_path):
    short = replace(settings, ledger_limit=2)
    where = {"table": str(tmp_path / "node"), "ledger": str(tmp_path / "ledger")}
    for _ in range(3):
        pub.publish(spark, first, lexicon, short, **where)
    assert sorted(r["seq"] for r in read_ledger(spark, where["ledger"]).collect()) == [2, 3]


def test_corrupt_ledger_does_not_lose_the_entry(spark, lexicon, settings, first, tmp_path):
    ledger = tmp_path / "ledger"
    (ledger / "v1").mkdir(parents=True)
    (ledger / "v1" / "_SUCCESS").write_text("")
    (ledger / "v1" / "part-0.json").write_text("{not json at all\n\x00\x01")
    got = pub.publish(spark, first, lexicon, settings, table=str(tmp_path / "node"), ledger=str(ledger))
    assert got.changed is None and read_ledger(spark, str(ledger)).count() == 1


def test_invalid_payload_is_refused_before_anything_is_kept(spark, lexicon, settings, first, tmp_path):
    bad = first.withColumn("extras", F.lit('{"note": "spray 4 ml/l"}'))
    with pytest.raises(va.InvalidPayload, match="prose"):
        pub.publish(spark, bad, lexicon, settings, table=str(tmp_path / "node"))
    assert not Path(tmp_path / "node").exists()


class Node:
    def __init__(self, answers):
        self.answers, self.calls = list(answers), []

    def __call__(self, url, headers, body):
        self.calls.append((url, headers["Idempotency-Key"], len(body["message"]["catalogs"])))
        answer = self.answers.pop(0)
        if isinstance(answer, Exception):
            raise answer
        return answer


def remote(settings):
    return replace(settings, node_url="http://node/", publish_backoff_seconds=0.5)


def test_transient_failures_are_retried_with_one_key(spark, lexicon, settings, first):
    ok = {"message": {"catalogProcessingResults": [{"catalogId": "c", "status": "ACCEPTED"}]}}
    node, naps = Node([pub.RejectedByNode(503), ConnectionError(), ok]), []
    got = pub.publish(spark, first, lexicon, remote(settings), transport=node, sleep=naps.append)
    assert got.status == "ACCEPTED" and got.catalog_ids == ["c"] and not got.round_trip_ok
    assert naps == [0.5, 1.0] and len({k for _, k, _ in node.calls}) == 1 and node.calls[0][0] == "http://node/catalog/publish"


def test_rejected_payload_is_sent_once(spark, lexicon, settings, first):
    node = Node([pub.RejectedByNode(400)])
    with pytest.raises(pub.RejectedByNode):
        pub.publish(spark, first, lexicon, remote(settings), transport=node, sleep=lambda s: None)
    assert len(node.calls) == 1


def test_attempts_end(settings):
    node = Node([TimeoutError()] * 3)
    with pytest.raises(TimeoutError):
        pub.send({"context": {"messageId": "m"}, "message": {"catalogs": []}}, remote(settings), node, lambda s: None)
    assert len(node.calls) == 3


def test_retry_classes_and_answer_folding(spark):
    assert [pub.is_retryable(pub.RejectedByNode(s)) for s in (429, 500, 502, 503, 504, 400, 404, 409)] == [True] * 5 + [False] * 3
    assert pub.is_retryable(ConnectionError()) and not pub.is_retryable(ValueError())
    answer = lambda *s: {"message": {"catalogProcessingResults": [{"status": x, "catalogId": x} for x in s]}}
    fold = lambda *answers: publishing.fold_statuses(pub.answered(spark, list(answers))).head()["status"]
    assert fold({}) == "ACCEPTED" and fold(answer("REJECTED")) == "REJECTED" and fold(answer("ACCEPTED", "REJECTED")) == "PARTIAL"
    assert fold({}, answer("REJECTED")) == "PARTIAL" and [r["catalog_id"] for r in pub.answered(spark, [{}]).collect()] == [None]


def test_stamps_of_one_publish_agree(spark, lexicon, settings, first, tmp_path):
    sent = []

    def node(url, headers, body):
        sent.append(body)
        return {}

    got = pub.publish(spark, first, lexicon, remote(settings), transport=node, ledger=str(tmp_path / "ledger"))
    saved = got.envelope.select("context.timestamp").head()[0]
    noted = read_ledger(spark, str(tmp_path / "ledger")).head()
    assert {sent[0]["context"]["timestamp"], saved, noted["timestamp"]} == {got.timestamp}
    assert noted["message_id"] == sent[0]["context"]["messageId"] == got.envelope.select("context.messageId").head()[0]
    assert got.validation["ok"] and got.validation["resources"] == first.count() and got.acknowledgement["status"] == "ACCEPTED"


def test_the_timeout_setting_reaches_the_request(settings, monkeypatch):
    asked = {}
    monkeypatch.setattr(pub, "post_json", lambda url, headers, body, timeout: asked.update(url=url, timeout=timeout) or {})
    pub.send({"context": {"messageId": "m"}}, replace(remote(settings), publish_timeout_seconds=7.5))
    assert asked == {"url": "http://node/catalog/publish", "timeout": 7.5}


def test_a_lost_ledger_write_keeps_the_history(spark, lexicon, settings, first, tmp_path):
    where = {"table": str(tmp_path / "node"), "ledger": str(tmp_path / "ledger")}
    pub.publish(spark, first, lexicon, settings, **where)
    broken = tmp_path / "ledger" / "v2"
    broken.mkdir()
    (broken / "part-0.json").write_text("{half a")  # a write that never ended
    assert read_ledger(spark, where["ledger"]).count() == 1
    pub.publish(spark, first, lexicon, settings, **where)
    assert sorted(r["seq"] for r in read_ledger(spark, where["ledger"]).collect()) == [1, 2]


def test_same_resource_from_two_documents_keeps_the_last(spark, lexicon, settings, make_pages, tmp_path):
    docs = {"alphaland_1.pdf": ["Alphaland. Lentil stands well." + PAD], "alphaland_2.pdf": ["Alphaland. Lentil and barley." + PAD]}
    own = onboard.catalogue(onboard.extract(make_pages(docs), lexicon, settings), lexicon, settings, by_document=True)
    got = pub.publish(spark, own, lexicon, settings, table=str(tmp_path / "node"))
    held = got.held.select(F.col("attributes.evidence.sourceDocuments").alias("d")).collect()
    assert [r["d"] for r in held] == [["alphaland_2.pdf"]]
