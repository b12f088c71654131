import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

@pytest.fixture
def frame(spark):
    """Documents as a table over a few partitions, with columns whose names clash."""
    def make(docs, parts=3):
        rows = [(i, t, "x", "y", 7) for i, t in docs]
        return spark.createDataFrame(
            rows, "doc_id long, text string, doc string, row string, n long").repartition(parts)
    return make


@pytest.fixture
def passages():
    """Documents that share passages, with empty, missing, repeated and very long texts."""
    draw = random.Random(5)
    words = ["".join(draw.choice("abcé") for _ in range(draw.randint(1, 7))) for _ in range(60)]
    shared = [[draw.choice(words) for _ in range(draw.randint(8, 60))] for _ in range(6)]
    docs = []
    for i in range(40):
        text = []
        for _ in range(draw.randint(0, 6)):
            text += (draw.choice(shared)[draw.randint(0, 6):] if draw.random() < 0.5
                     else [draw.choice(words) for _ in range(draw.randint(0, 30))])
        docs.append((i, "".join(w + draw.choice([" ", " ", "\n", "  ", "\t"]) for w in text)))
    return docs + [(40, None), (41, ""), (None, docs[3][1]), (42, docs[3][1]), (42, docs[3][1]),
                   (43, "aé" * 400), (44, "x y " * 300), (45, " ".join(words) * 90)]
