"""Providers for the tests, named by configurations."""

import json
import os
import zlib

from quillmill.operators.providers import ProviderError, Result


class Fake:
    """A provider whose answers come from a dictionary or a function, and failures from a list of kinds given first."""

    def __init__(self, name, answer, score=0.99, failures=(), model="fake-1"):
        self.name, self.model, self.answer, self.score, self.failures = name, model, answer, score, list(failures)

    async def recognize(self, payload):
        if self.failures:
            raise ProviderError(self.failures.pop(0))
        content = self.answer(payload) if callable(self.answer) else self.answer.get(payload, "")
        return Result(content if isinstance(content, str) else json.dumps(content, ensure_ascii=False), self.score, f"{self.name}-{zlib.crc32(payload)}")


def verifier():
    def judge(payload):
        asked = json.loads(payload.decode().split("\n", 1)[1])
        return {"verdict": "PASS", "score": 0.999, "reason": "numbers agree", "cited_blocks": asked["block_ids"]}

    return Fake("judge", judge)


def counting():
    class Counting(Fake):  # local, so that it goes to other processes by value
        """Notes each call in a file."""

        async def recognize(self, payload):
            with open(self.notes, "a") as notes:
                notes.write("x")
            return await Fake.recognize(self, payload)

    made = Counting("judge", verifier().answer)
    made.notes = os.environ["FAKE_CALLS"]
    return made


def meddler():
    return Fake("meddler", lambda payload: {"verdict": "PASS", "score": 0.999, "reason": "", "cited_blocks": json.loads(payload.decode().split("\n", 1)[1])["block_ids"], "answer": "better"})


def splitter():
    """Proposes a question from each block with a question mark up to the next one."""

    def split(payload):
        blocks = json.loads(payload.decode().split("\n", 1)[1])["blocks"]
        starts = [i for i, b in enumerate(blocks) if "?" in (b.get("raw_text") or "")]
        return {"questions": [{"first": blocks[i]["block_id"], "last": blocks[j - 1]["block_id"]} for i, j in zip(starts, [*starts[1:], len(blocks)], strict=True)]}

    return Fake("splitter", split)


def formula_reader():
    return Fake("formula", {b"preview": r"\frac{1}{2}"}, 0.99)
