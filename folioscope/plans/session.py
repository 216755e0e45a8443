"""A session of questions: modes, commands, history. What a terminal needs, without the terminal."""

from __future__ import annotations

import json
import time
from collections import deque
from dataclasses import asdict

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscope.functions import models
from folioscope.plans import display
from folioscope.plans.retriever import Retriever

MODES = ("retrieve", "answer", "graph")
MOST_HISTORY, MOST_TOP = 20, 20


class Session:
    """Takes a line, gives a text. Lines that begin with a slash are commands, others are questions.

    Commands: /mode M, /top N, /project P, /rerank on|off, /format F, /history, /last, /trace, /stats, /help.
    """

    def __init__(self, retriever: Retriever, *, project: str | None = None, answer=None):
        self.retriever, self.project, self.answer = retriever, project, answer
        self.mode, self.top, self.rerank, self.format = "retrieve", 5, False, "compact"
        self.history: deque[dict] = deque(maxlen=MOST_HISTORY)
        self.trace: dict = {}

    def line(self, text: str) -> str:
        text = text.strip()
        if not text:
            return ""
        if text.startswith("/"):
            name, _, value = text[1:].partition(" ")
            command = getattr(self, f"_do_{name}", None)
            return command(value.strip()) if command else f"no command {name}; try /help"
        return self.ask(text)

    def ask(self, question: str) -> str:
        began = time.perf_counter()
        graph = self.mode == "graph"
        hits, trace = self.retriever.retrieve(question, project=self.project, k=self.top, graph=graph or self.mode == "answer", rerank=self.rerank)
        rows = hits.orderBy(F.desc("score"), "chunk_id").collect()  # at most MOST_TOP rows
        said = "\n".join(f"{r.score:.4f} {r.chunk_id} {r.content[:120]!r}" for r in rows) or "nothing found"
        if self.mode == "answer" and rows:
            said = self._answered(question, [r.content for r in rows]) + "\n\n" + said
        if graph and self.retriever.nodes is not None:
            said += "\n\n" + display.FORMATS[self.format](*display.limited(self._own(self.retriever.nodes), self.retriever.edges))
        self.trace = asdict(trace)
        self.history.append({"question": question, "mode": self.mode, "hits": len(rows), "seconds": round(time.perf_counter() - began, 3)})
        return said

    def _own(self, nodes: DataFrame) -> DataFrame:
        return nodes if self.project is None else nodes.filter(F.col("project_id") == self.project)

    def _answered(self, question: str, contexts: list[str]) -> str:
        if self.answer is not None:
            return self.answer(["\n\n".join([*contexts, question])])[0]
        return self.retriever.spark.range(1).select(models.extractive_answer(F.lit(contexts[0])).alias("a")).first().a

    def _do_mode(self, value: str) -> str:
        if value not in MODES:
            return f"modes: {', '.join(MODES)}"
        self.mode = value
        return f"mode {value}"

    def _do_top(self, value: str) -> str:
        if not value.isdigit():
            return "a number"
        self.top = min(MOST_TOP, max(1, int(value)))
        return f"top {self.top}"

    def _do_project(self, value: str) -> str:
        self.project = value or None
        return f"project {self.project or 'all'}"

    def _do_rerank(self, value: str) -> str:
        self.rerank = value == "on"
        return f"rerank {'on' if self.rerank else 'off'}"

    def _do_format(self, value: str) -> str:
        if value not in display.FORMATS:
            return f"formats: {', '.join(display.FORMATS)}"
        self.format = value
        return f"format {value}"

    def _do_history(self, _: str) -> str:
        return "\n".join(f"{h['mode']} {h['hits']} hits {h['seconds']} s: {h['question']}" for h in self.history)

    def _do_last(self, _: str) -> str:
        return self.ask(self.history[-1]["question"]) if self.history else "no question yet"

    def _do_trace(self, _: str) -> str:
        return json.dumps(self.trace, ensure_ascii=False)

    def _do_stats(self, _: str) -> str:
        return f"{len(self.history)} questions, {sum(h['seconds'] for h in self.history):.1f} s"

    def _do_help(self, _: str) -> str:
        return (Session.__doc__ or "").strip().splitlines()[-1].strip()
