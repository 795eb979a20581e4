import subprocess
import sys

from sensorlake.session import package_archive


def test_archive_of_the_package_imports(tmp_path):
    """What a cluster's executors get is the whole package."""
    path = package_archive(str(tmp_path))
    code = f"import sys; sys.path.insert(0, {path!r}); import sensorlake.plans.scripts as s; print(s.__file__)"
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=tmp_path, check=True)
    assert out.stdout.startswith(path)
