"""Command line: ``python -m ratewave.cli <command> ...`` (or spark-submit).

* ``train``     ratings text -> clean -> split -> ALS with quality gate -> saved model
* ``stream``    Kafka topic or JSON-line folder -> trending, alerts, user windows,
                per-batch lag metrics and Top-k recommendations
* ``recommend`` saved model + user ids -> Top-k per user
* ``report``    stored stream output -> counters, top trending, latest alerts
* ``compact``   stored stream output -> old batches folded into large files
"""

from __future__ import annotations

import argparse
import json
import logging
import sys

from ratewave.operators.windows import DEFAULT_SIZE, DEFAULT_SLIDE, DEFAULT_WATERMARK
from ratewave.session import build_session
from ratewave.sources.streams import DEFAULT_STARTING_OFFSETS, DEFAULT_TOPIC
from ratewave.streaming.app import RECS_TRIGGER, WINDOW_TRIGGER


def _train(spark, a) -> int:
    from ratewave.models.als import BASELINE, RETUNE, RMSE_GATE, gated_retune, with_int_ids
    from ratewave.models.versions import publish_model
    from ratewave.operators.cleaning import clean_ratings
    from ratewave.operators.sampling import SPLIT_KEYS, hash_split, numbered_copies
    from ratewave.session import materialize
    from ratewave.sources.files import read_ratings_text

    raw = read_ratings_text(spark, a.ratings, sep=a.sep, header=not a.no_header)
    table, maps = with_int_ids(materialize(numbered_copies(clean_ratings(raw)), "cli_ratings"))
    print(f"valid ratings: {table.count()}")
    train, test = hash_split(table, [0.8, 0.2], a.seed, SPLIT_KEYS)
    blocks = {"num_blocks": a.blocks} if a.blocks else {}
    model, report = gated_retune(train, test, BASELINE, [RETUNE], RMSE_GATE, keep_best=a.keep_best, **blocks)
    for row in report:
        print(json.dumps(row))
    print(f"model saved to {publish_model(model, a.model, maps)}")
    return 0


def _stream(spark, a) -> int:
    from ratewave.functions.parse import parse_events
    from ratewave.models.versions import LatestModel
    from ratewave.sources.streams import read_event_files, read_kafka
    from ratewave.streaming.app import WindowSpec, start_app
    from ratewave.streaming.progress import ProgressStore

    if a.kafka:
        raw = read_kafka(spark, bootstrap_servers=a.kafka, topic=a.topic,
                         starting_offsets=a.starting_offsets,
                         max_offsets_per_trigger=a.max_offsets_per_trigger)
    else:
        raw = read_event_files(spark, a.files, max_files_per_trigger=a.max_files_per_trigger)
    events = parse_events(raw)
    latest = LatestModel(spark, a.model) if a.model else None
    if latest:
        latest.get()  # a folder without a model fails here, not in the first batch
    spec = WindowSpec(a.size, a.slide, a.watermark)
    trigger = "available_now" if a.available_now else a.trigger
    recs_trigger = "available_now" if a.available_now else a.recs_trigger
    spark.streams.addListener(ProgressStore(spark, a.out, ["trending_final", "trending_updates", "user_windows"]))
    queries = start_app(events, a.out, None, spec, trigger, recs_trigger, console_rows=a.console_rows,
                        latest=latest)
    if a.available_now:
        for q in queries.values():
            q.awaitTermination()
    else:
        spark.streams.awaitAnyTermination()
    return 0


def _recommend(spark, a) -> int:
    from ratewave.models.als import load_id_maps, load_model
    from ratewave.models.versions import current_model
    from ratewave.sources.files import id_frame
    from ratewave.streaming.scoring import batch_recommendations

    path = current_model(spark, a.model)
    maps = load_id_maps(spark, path)
    users = id_frame(spark, a.users)
    recs = batch_recommendations(load_model(path), users, a.k, maps)
    recs.orderBy("user_id").show(len(a.users), truncate=False)
    return 0


def _report(spark, a) -> int:
    from ratewave.operators.serving import first_recs, top_trending
    from ratewave.schemas import RECS_OUT
    from ratewave.sources.files import read_result_dir
    from ratewave.streaming.summaries import latest_stored_alerts, stored_best, stored_counters, stored_recs_counters

    stored_counters(spark, a.out).show(truncate=False)
    stored_recs_counters(spark, a.out).show(truncate=False)
    first_recs(read_result_dir(spark, f"{a.out}/recs", RECS_OUT), a.recs).show(a.recs, truncate=False)
    top_trending(stored_best(spark, a.out), a.top).show(a.top, truncate=False)
    latest_stored_alerts(spark, a.out, a.alerts).show(a.alerts, truncate=False)
    return 0


def _compact(spark, a) -> int:
    from ratewave.streaming.compaction import compact_outputs, outputs, remove_folded

    for name, manifest in compact_outputs(spark, a.out).items():
        print(f"{name}: batches up to {manifest.through} in {len(manifest.parts)} part(s)")
    if a.remove_after is not None:
        removed = sum(remove_folded(spark, f"{a.out}/{name}", a.remove_after) for name, _, _ in outputs(spark, a.out))
        print(f"removed: {removed}")
    return 0


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="ratewave")
    p.add_argument("--master", default=None)
    p.add_argument("--shuffle-partitions", type=int, default=None)
    sub = p.add_subparsers(dest="cmd", required=True)

    t = sub.add_parser("train")
    t.add_argument("--ratings", required=True)
    t.add_argument("--model", required=True)
    t.add_argument("--sep", default=",")
    t.add_argument("--no-header", action="store_true")
    t.add_argument("--seed", type=int, default=42)
    t.add_argument("--keep-best", action="store_true")
    t.add_argument("--blocks", type=int, default=None, help="ALS factor blocks (default: models.als.DEFAULT_BLOCKS)")

    s = sub.add_parser("stream")
    src = s.add_mutually_exclusive_group(required=True)
    src.add_argument("--kafka", help="bootstrap servers")
    src.add_argument("--files", help="folder of JSON-line files")
    s.add_argument("--topic", default=DEFAULT_TOPIC)
    s.add_argument("--starting-offsets", default=DEFAULT_STARTING_OFFSETS)
    s.add_argument("--max-offsets-per-trigger", type=int, default=None)
    s.add_argument("--max-files-per-trigger", type=int, default=None)
    s.add_argument("--out", required=True)
    s.add_argument("--model", default=None)
    s.add_argument("--size", default=DEFAULT_SIZE)
    s.add_argument("--slide", default=DEFAULT_SLIDE)
    s.add_argument("--watermark", default=DEFAULT_WATERMARK)
    s.add_argument("--trigger", default=WINDOW_TRIGGER)
    s.add_argument("--recs-trigger", default=RECS_TRIGGER)
    s.add_argument("--available-now", action="store_true")
    s.add_argument("--console-rows", type=int, default=0)

    r = sub.add_parser("recommend")
    r.add_argument("--model", required=True)
    r.add_argument("--users", type=int, nargs="+", required=True)
    r.add_argument("-k", type=int, default=5)

    o = sub.add_parser("report")
    o.add_argument("--out", required=True)
    o.add_argument("--top", type=int, default=10)
    o.add_argument("--alerts", type=int, default=20)
    o.add_argument("--recs", type=int, default=20)

    c = sub.add_parser("compact")
    c.add_argument("--out", required=True)
    c.add_argument("--remove-after", type=float, default=None,
                   help="also delete what has been folded for so many seconds")

    return p.parse_args(argv)


HANDLERS = {"train": _train, "stream": _stream, "recommend": _recommend, "report": _report, "compact": _compact}


def run(spark, argv: list[str]) -> int:
    a = parse_args(argv)
    return HANDLERS[a.cmd](spark, a)


def main(argv: list[str] | None = None) -> int:
    logging.basicConfig(level=logging.INFO, format="[%(name)s] %(message)s")
    a = parse_args(argv)
    spark = build_session(a.master, shuffle_partitions=a.shuffle_partitions)
    return HANDLERS[a.cmd](spark, a)


if __name__ == "__main__":
    sys.exit(main())
