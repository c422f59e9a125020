"""Stand-in clients; shipped to the workers, as a user would ship a client of their own."""

from pyspark import AccumulatorParam


class FixedEmbedder:
    """vector[i] = (i mod 10) / 10 for every text; refuses batches that are too long."""

    def embed_batch(self, texts):
        assert len(texts) <= 50
        return [[(i % 10) / 10 for i in range(32)] for _ in texts]


class ShortEmbedder:
    def embed_batch(self, texts):
        return [[0.0] * 32 for _ in texts[1:]]


class NarrowEmbedder:
    def embed_batch(self, texts):
        return [[0.0] * 31 for _ in texts]


class BrokenEmbedder:
    def embed_batch(self, texts):
        raise TimeoutError("no answer")


class NeverAsked:
    def embed_batch(self, texts):
        raise AssertionError("no phrase is new")


class EchoNamer:
    def complete_json(self, system, user):
        if "boom" in user:
            raise ConnectionError("down")
        if "half" in user:
            return {"nome": "only a name"}
        if "text" in user:
            return "this is not JSON"
        return {"nome": user.splitlines()[-1], "dor": str(len(user.splitlines()))}


class Texts(AccumulatorParam):
    """Lists put together, as an accumulator."""

    def zero(self, value):
        return []

    def addInPlace(self, value1, value2):
        return value1 + value2
