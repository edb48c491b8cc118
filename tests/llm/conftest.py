import pytest

WORDS = "amber birch cedar delta ember frost grove haven inlet jade knoll lunar maple north ocean pearl quartz river stone tundra umber vale willow xenon yarrow zephyr".split()


def prose(seed: int, n: int) -> str:
    """Words in an order that no other seed gives."""
    out, x = [], seed * 7919 + 13
    for _ in range(n):
        x = (x * 1103515245 + 12345) % 2**31
        out.append(WORDS[x // 65536 % len(WORDS)] + str(x % 97))
    return " ".join(out)


@pytest.fixture(scope="session")
def docs(spark):
    """Rows with null and empty texts, a null id, repeats, and a column whose name clashes."""

    def make(rows):
        return spark.createDataFrame([(i, t, "x", 7) for i, t in rows], "doc_id long, text string, TEXT_ string, piece int")

    return make
