"""Run a job: ``spark-submit --py-files shelfwise.zip shelfwise/__main__.py retrain …``.

All paths may be URIs of any file system Spark can reach.
"""

import argparse

from shelfwise.operators.factorize import AlsSettings
from shelfwise.plans import jobs
from shelfwise.plans.publish import CurrentModel
from shelfwise.schemas import DEFAULT_N, LIST_LENGTH, MAX_ITER, RANK, REG_PARAM
from shelfwise.session import build_session
from shelfwise.streaming.requests import request_stream, serve_stream


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="shelfwise", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)

    def command(name, *paths, **options):
        sub = commands.add_parser(name)
        for path in paths:
            sub.add_argument(path)
        for option, settings in options.items():
            sub.add_argument("--" + option.replace("_", "-"), **settings)
        return sub

    lines = {
        "multi_line": {"action": argparse.BooleanOptionalAction, "default": True},
        "whole_files": {"action": "store_true"},
        "on_malformed": {"choices": ["fail", "drop"], "default": "fail"},
    }
    raw = {
        "file_format": {"choices": ["csv", "parquet"], "default": "csv"},
        "on_bad_rating": {"choices": ["fail", "drop"], "default": "fail"},
        **lines,
    }
    model = {
        "rank": {"type": int, "default": RANK},
        "max_iter": {"type": int, "default": MAX_ITER},
        "reg_param": {"type": float, "default": REG_PARAM},
        "split": {"choices": list(jobs.SPLITS), "default": "random"},
        "top": {"type": int},
        "keep_ids": {"action": "store_true"},
    }
    command("convert", "csv_path", "parquet_path", **lines)
    command("clean", "raw_path", "out_path", **raw, csv_path={})
    command(
        "train", "ratings_path", "root", **model,
        file_format={"choices": ["csv", "parquet"], "default": "parquet"},
    )
    command("retrain", "raw_path", "root", **raw, **model)
    command("recommend", "root", "out_path", k={"type": int, "default": LIST_LENGTH})
    command("serve", "requests_path", "root", "answers_path", "log_path", "batch")
    answer = command("answer", "root", "answers_path", "log_path")
    answer.add_argument("user_id", type=int)
    answer.add_argument("--n", type=int, default=DEFAULT_N)
    command("stream", "requests_path", "root", "answers_path", "log_path", "checkpoint",
            repeats_within={})
    return top


def run(spark, args):
    """Run the command and return what its job returns."""
    options = {k: v for k, v in vars(args).items() if k != "command"}
    if args.command in ("train", "retrain"):
        options["settings"] = AlsSettings(
            rank=options.pop("rank"), max_iter=options.pop("max_iter"),
            reg_param=options.pop("reg_param"),
        )
    if args.command == "stream":
        query = serve_stream(
            request_stream(spark, args.requests_path, repeats_within=args.repeats_within),
            CurrentModel(spark, args.root),
            args.answers_path, args.log_path, args.checkpoint,
        )
        return query.awaitTermination()
    job = {
        "convert": jobs.convert_job, "clean": jobs.clean_job, "train": jobs.train_job,
        "retrain": jobs.retrain, "recommend": jobs.recommend_all_job, "serve": jobs.serve_job,
        "answer": jobs.answer_job,
    }[args.command]
    return job(spark, **options)


def main(argv=None):
    args = parser().parse_args(argv)
    spark = build_session(f"shelfwise-{args.command}")
    print(run(spark, args))
    spark.stop()


if __name__ == "__main__":
    main()
