"""Functions that run in tasks load where the package is not installed."""

from __future__ import annotations

import importlib
import inspect
import pkgutil
import subprocess
import sys

from pyspark import cloudpickle

import fumeline.llm

LOAD = "import pickle, sys; f = pickle.load(sys.stdin.buffer); assert 'fumeline' not in sys.modules; print(f.__name__)"


def shipped():
    for module in pkgutil.iter_modules(fumeline.llm.__path__):
        own = importlib.import_module(f"fumeline.llm.{module.name}")
        for f in vars(own).values():
            if inspect.isfunction(f) and f.__module__ == own.__name__:
                first = next(iter(inspect.signature(f).parameters.values()), None)
                if first and (first.name == "batches" or "pa.Table" in str(first.annotation)):
                    yield f


def test_functions_load_without_the_package(tmp_path):
    found = list(shipped())
    assert len(found) > 20
    for f in found:
        out = subprocess.run([sys.executable, "-I", "-c", LOAD], input=cloudpickle.dumps(f), cwd=tmp_path, capture_output=True)
        assert out.stdout.decode().strip() == f.__name__, (f.__module__, f.__name__, out.stderr.decode()[-300:])
