"""Choose op7's constants inside the folds that may teach: python -m tests.llm.choose_toxicity DIR...

Each of the remainders 0, 1 and 3 is judged by a model of the other two; rows of remainder 2 are not loaded.  A text
that the model has seen is left out.  The table is sorted by the F1 at the query's threshold.
"""

import itertools
import os
import sys
import zlib

import duckdb
import numpy as np
import pyarrow as pa

from halocline.llm import toxicity

GRID = list(itertools.product((2, 3, 4, 6), (512, 2048, 4096), ((0, 0), (0.02, 5e-4), (0.1, 1e-4), (0.1, 5e-4), (0.1, 2e-3), (0.4, 5e-4), (0.4, 2e-3), (0.4, 1e-2)), (200, 600)))


def fold(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4


def judged(folder):
    def table(name):
        path = f"{folder}/{name}.parquet"
        return path if os.path.isfile(path) else f"{path}/*.parquet"

    docs = [(d, t) for d, t in duckdb.sql(f"select doc_id, text from '{table('documents')}' order by doc_id").fetchall() if fold(d) != 2]
    toxic = {d: y for d, y in duckdb.sql(f"select doc_id, toxic from '{table('labels')}'").fetchall() if fold(d) != 2}
    words = {d: np.unique(toxicity.rows_words(pa.array([t]))[1]) for d, t in docs}
    text = dict(docs)
    ids = [docs[i][0] for i in np.random.default_rng(0).permutation(len(docs))]
    out = {}
    for val in (0, 1, 3):
        teach = [d for d in ids if fold(d) != val]
        seen = {text[d] for d in teach}
        test = [d for d in ids if fold(d) == val and d in toxic and text[d] not in seen]
        y = np.array([toxic[d] for d in test])
        positive = [words[d] for d in teach if toxic.get(d) == 1][: toxicity.MAX_POSITIVE]
        unlabelled = [words[d] for d in teach][: toxicity.MAX_UNLABELLED]
        prior = float(np.mean([toxic[d] for d in teach if d in toxic]))
        for key in GRID:
            toxicity.SURPRISE, size, (toxicity.RIDGE, toxicity.MOST_RIDGE), steps = key
            if size != 4096 and key[0] != 4:
                continue
            model = toxicity.fit(positive, unlabelled, prior, size, steps)
            said = np.array([model.score(np.zeros(len(words[d]), np.int64), words[d], 1)[0] for d in test]) >= toxicity.THRESHOLD
            out[key] = out.get(key, 0) + np.array([(said & (y == 1)).sum(), said.sum(), y.sum()])
    return out


if __name__ == "__main__":
    tables = [judged(folder) for folder in sys.argv[1:]]
    rows = [(np.mean([2 * t[k][0] / (t[k][1] + t[k][2]) for t in tables]), k, [(t[k][0] / t[k][1], t[k][0] / t[k][2]) for t in tables]) for k in tables[0]]
    for mean, key, each in sorted(rows, key=lambda r: -r[0]):
        print(f"{mean:.4f}", key, [f"{p:.3f} {r:.3f}" for p, r in each])
