"""Small inputs for the operators' tests."""


def documents(spark, rows, extra=True):
    """(doc_id, text) rows as a table with extra columns whose names operators use inside."""
    names = "row int, part string, count int, rest int, block int, data binary" if extra else ""
    schema = "doc_id bigint, text string" + (", " + names if extra else "")
    return spark.createDataFrame([(i, t, *([None] * 6 if extra else [])) for i, t in rows], schema)


def tuples(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def passages(draw, width):
    """Documents that share passages a little shorter and longer than a window, and repeat themselves."""
    vocabulary = [f"w{k}" for k in range(400)]
    shared = [draw.choices(vocabulary, k=width + draw.randint(-2, 15)) for _ in range(6)]
    rows = []
    for doc_id in range(60):
        words = []
        for _ in range(draw.randint(0, 4)):
            words += draw.choices(vocabulary, k=draw.randint(0, width))
            words += draw.choice(shared)
        if doc_id % 10 == 3:
            words += ["again"] * (2 * width)
        rows.append((doc_id, " ".join(words)))
    rows += [(100, rows[7][1]), (101, rows[7][1]), (7, rows[7][1]), (None, rows[7][1]), (102, None), (103, " \n ")]
    draw.shuffle(rows)
    return rows
