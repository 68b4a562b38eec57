"""Benchmark: headline jobs on $BENCH_SF_DIR (default sf0.1), local[$BENCH_CPUS]; prints one JSON line.

Each job runs to completion into Spark's ``noop`` sink (nothing is collected).
The tokenizer is trained once (timed as ``bpe_train``) and reused by the
jobs after it, as files are reused between the reference's commands.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from wordloom.operators import sgns  # noqa: E402
from wordloom.plans import catalog  # noqa: E402
from wordloom.session import build_session  # noqa: E402
from wordloom.sources.options import TrainOptions  # noqa: E402

HEADLINE = [
    "word_frequency",
    "pair_frequency",
    "bpe_train",
    "encode_documents",
    "token_positions",
    "skipgram_pairs",
    "skipgram_pairs_global",
    "sampling_cdf",
    "sgns_epoch",
    "centroids",
    "standardize",
    "gram_matrix",
    "matrix_multiply",
    "knn_exact",
    "knn_pivots",
    "similarity_join",
    "bpe_train_large",
]


def sgns_epoch(spark, sf_dir):
    """One epoch of the trainer with default options: every pair occurrence and all its draws."""
    kept, model = catalog._kept(spark, sf_dir)
    return sgns.sgns_fit(kept, model.vocab, TrainOptions(seed=catalog.SEED, epochs=1)).vectors


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:] or HEADLINE
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(int(cpus), 8))
    times = {}
    for name in only:
        fn = sgns_epoch if name == "sgns_epoch" else catalog.REGISTRY[name][0]
        t0 = time.time()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        print(f"{name}: {times[name]}s", file=sys.stderr, flush=True)
    sf = os.path.basename(os.path.normpath(sf_dir)).replace("sf", "")
    print(json.dumps({"metric": "total_headline_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
