"""The operators' Python workers find the package when the driver runs elsewhere."""

import os
import subprocess
import sys
import textwrap

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_queries_run_from_another_folder(tmp_path):
    code = f"""
        import importlib.util
        spec = importlib.util.spec_from_file_location("entry_elsewhere", {os.path.join(REPO, "__spark_entry__.py")!r})
        entry = importlib.util.module_from_spec(spec)
        spec.loader.exec_module(entry)
        from basketry.session import build_session
        spark = build_session("local[2]", shuffle_partitions=2)
        for name in ("op8_site_quality", "op12_byte_bpe"):
            assert entry.queries()[name](spark, "/root/testdata/sf0.001").count() > 0
        """
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", textwrap.dedent(code)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert run.returncode == 0, run.stderr[-2000:]
