"""Scratch memory of workers that live on."""

from ledgerline.llm import spans


def test_memory_is_given_back_when_a_task_ends(monkeypatch):
    given = []
    monkeypatch.setattr(spans, "give_back", lambda: given.append(1))
    work = spans.giving_back(lambda batches: (2 * x for x in batches))
    assert list(work(iter([1, 2]))) == [2, 4] and len(given) == 1
    early = work(iter([1, 2]))
    assert next(early) == 2 and len(given) == 1
    early.close()
    assert len(given) == 2
