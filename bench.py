"""Times the headline queries; prints one JSON line.

Every query is written to a no-op sink, so all rows and columns are computed
and none reaches the driver. The first run of each query warms the JVM; the
fastest of the following runs counts.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pairloom.catalog.spark_queries import registered  # noqa: E402
from pairloom.session import session_builder  # noqa: E402

HEADLINE = (
    "normalize_text",
    "token_f1",
    "bleu",
    "rouge",
    "meteor",
    "ngram_overlap",
    "meteor_stem_synonyms",
    "soft_alignment",
    "bert_score_texts",
    "mrc_report",
    "eval_report",
    "score_examples",
    "pair_by_key",
    "pair_by_position",
    "render_chat",
    "generation_prompt",
    "split_response",
    "drop_marked",
    "unpivot_targets",
    "flatten_qa",
    "summary_pairs",
    "choice_pairs",
    "mrc_pairs",
    "split_exact",
    "split_threshold",
    "count_tokens",
    "pack_sequences",
    "batch_generate",
    "throughput",
    "throughput_actual",
    "epoch_throughput",
    "sample_metrics",
    "throughput_stream",
    "csv_round_trip",
    "splits_round_trip",
)


def main(names: list[str]) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = (
        session_builder("pairloom-bench")
        .master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registered()

    def timed(name: str) -> float:
        begin = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - begin

    seconds = {}
    for name in names:
        timed(name)
        seconds[name] = round(min(timed(name) for _ in range(runs)), 3)
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:] or list(HEADLINE))
