"""``python -m phrasemill run|extract|rank|cluster|count --config ranking.json [--extract-config extract.json]``."""

from __future__ import annotations

import argparse

from .config import ExtractConfig, RankConfig, load_json
from .plans.pipeline import Pipeline
from .plans.session import build_session


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="phrasemill")
    p.add_argument("stage", choices=["run", "extract", "rank", "cluster", "count"])
    p.add_argument("--config", required=True)
    p.add_argument("--extract-config")
    a = p.parse_args(argv)
    cfg = RankConfig.from_dict(load_json(a.config))
    ecfg = ExtractConfig.from_dict(load_json(a.extract_config)) if a.extract_config else ExtractConfig()
    pipe = Pipeline(build_session(), cfg, ecfg)
    if a.stage == "run":
        for stage, ran in pipe.run().items():
            print(stage, "done" if ran else "skipped: output is complete")
    else:
        print(a.stage, "done" if getattr(pipe, f"run_{a.stage}")() else "skipped: output is complete")
    if pipe.chunk_report is not None:
        for r in pipe.chunk_report.orderBy("chunk_id").limit(20).collect():
            print(r["chunk_id"], r["n_candidates"], "distinct candidates")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
