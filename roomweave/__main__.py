"""python -m roomweave generate|library|render-tasks|dashboard: the batch runs over folders of scenes and questions."""

from __future__ import annotations

import argparse
import json
import time

from pyspark.sql import SparkSession

from roomweave.config import MAX_FOCUS_OBJECTS, MIN_FOCUS_OBJECTS, PATTERNS, QUESTION_TYPES, Pipeline
from roomweave.operators import rollup
from roomweave.plans import generate, library
from roomweave.session import durable
from roomweave.sources import readers, sinks


def main(args: list[str] | None = None) -> int:
    top = argparse.ArgumentParser(prog="roomweave")
    sub = top.add_subparsers(dest="run", required=True)
    g = sub.add_parser("generate", help="scene folders to questions")
    g.add_argument("--scenes-root", required=True)
    g.add_argument("--output", required=True)
    g.add_argument("--scenes", nargs="*", help="scene ids; all with labels if left out")
    g.add_argument("--max-objects", type=int, default=MAX_FOCUS_OBJECTS)
    g.add_argument("--min-objects", type=int, default=MIN_FOCUS_OBJECTS)
    lib = sub.add_parser("library", help="scene folders to a dataset of questions on all valid objects")
    lib.add_argument("--scenes-root", required=True)
    lib.add_argument("--output", required=True)
    lib.add_argument("--config", help="a JSON file with settings")
    r = sub.add_parser("render-tasks", help="poses whose image isn't there, or image paths of those that are")
    r.add_argument("--data", required=True)
    r.add_argument("--output", required=True)
    r.add_argument("--update-only", action="store_true")
    d = sub.add_parser("dashboard", help="statistics of a question folder")
    d.add_argument("--data", required=True)
    d.add_argument("--output", required=True)
    a = top.parse_args(args)
    spark, began = SparkSession.builder.appName("roomweave").getOrCreate(), time.time()
    if a.run == "generate":
        labels, structure = readers.labels(spark, a.scenes_root, a.scenes), readers.structures(spark, a.scenes_root, a.scenes)
        made = generate.generate(labels, structure, most=a.max_objects, least=a.min_objects)
        sinks.write_questions(made, f"{a.output}/_parts")
        sinks.publish_scene_files(spark, f"{a.output}/_parts", a.output)
        written = readers.questions(spark, a.output)
        meta = durable(generate.runs(labels, structure, written, most=a.max_objects, least=a.min_objects))
        sinks.write_runs(meta, a.output)
        summary = rollup.generation_summary(readers.scenes(spark, a.scenes_root, a.scenes), meta) | {
            "patterns": [p for p, *_ in PATTERNS], "question_types": sorted(QUESTION_TYPES), "max_objects_per_scene": a.max_objects, "elapsed_minutes": round((time.time() - began) / 60, 1),
        }
        sinks.write_document(spark, summary, f"{a.output}/generation_summary.json")
        print(f"{summary['total_questions']} questions, {summary['scenes_processed']} of {summary['total_scenes']} scenes in {summary['elapsed_minutes']} minutes")
    elif a.run == "library":
        given = json.loads("".join(r.value for r in spark.read.text(a.config, wholetext=True).collect())) if a.config else {}
        cfg = Pipeline.from_dict(given | {"scenes_root": a.scenes_root, "output_dir": a.output})
        labels, structure = readers.labels(spark, a.scenes_root, cfg.scene_list), readers.structures(spark, a.scenes_root, cfg.scene_list)
        made = durable(library.run(labels, structure, cfg))
        said = sinks.write_dataset(made, a.output, cfg.to_dict(), readers.scenes(spark, a.scenes_root, cfg.scene_list))
        print(f"{said['total_questions']} questions of {said['num_scenes']} scenes in {(time.time() - began) / 60:.1f} minutes")
    elif a.run == "render-tasks":
        q, images = readers.questions(spark, a.data), readers.image_paths(spark, a.data)
        if a.update_only:
            sinks.update_image_paths(q, images, a.output)
        else:
            rollup.missing_images(q, images).write.mode("overwrite").json(a.output)
    else:
        sinks.write_dashboard(readers.questions(spark, a.data), readers.metadata(spark, a.data), a.output, sorted(QUESTION_TYPES))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
