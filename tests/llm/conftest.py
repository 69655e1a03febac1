import random

import pytest


@pytest.fixture(scope="session")
def prose():
    """Documents with shared passages, copies, near copies, empty, null and very long texts."""
    rnd = random.Random(5)
    vocab = [f"w{chr(97 + i % 26)}{i}" for i in range(400)] + ["Élan", "straße", "ñandú", "the", "of"]

    def words(n):
        return [rnd.choice(vocab) for _ in range(n)]

    shared = [" ".join(words(60)) for _ in range(4)]
    line = "This line of more than forty code points repeats everywhere."
    texts = [None, "", "   \n\t", "one", "two words", "\n\n\n"]
    for i in range(60):
        body = words(rnd.randint(5, 120))
        text = " ".join(body[: len(body) // 2]) + "\n" + (shared[i % 4] if i % 5 == 0 else "") + "\n" + " ".join(body[len(body) // 2:])
        if i % 3 == 0:
            text += "\n  " + (line if i % 2 else line.upper()) + "\t"
        texts.append(text)
        if i % 10 == 0:
            texts += [text, text.replace("the", "of", 1), text + " extra"]
    texts.append(" ".join(words(30000)))
    texts.append("x" * 200_000)
    return [(i, t) for i, t in enumerate(texts)], shared


@pytest.fixture()
def docs(spark, prose):
    return spark.createDataFrame([(i, t, "z") for i, t in prose[0]], "doc_id long, text string, n_words string").repartition(3)
