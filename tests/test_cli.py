from __future__ import annotations

import json

import pytest

from depthloom import cli, registry


def test_list_and_doctor(capsys):
    assert cli.main(["list"]) == 0 and "sunrgbd: nuscenes, occ" in capsys.readouterr().out
    assert cli.main(["doctor"]) == 0


def test_diff_and_info(spark, tmp_path, capsys):
    for name, held in (("nuscenes", {"1": "aaa", "2": "bbb", "3": "ccc"}), ("occ", {"1": "aaa", "2": "XXX", "4": "ddd"})):
        (tmp_path / f"manifest_{name}.json").write_text(json.dumps({"frames": 3, "entries": {k: {"md5": v, "count": 1, "bytes": 2} for k, v in held.items()}}))
    assert cli.main(["diff", str(tmp_path / "manifest_nuscenes.json"), str(tmp_path / "manifest_occ.json")]) == 1
    assert json.loads(capsys.readouterr().out.splitlines()[0]) == {"same": 1, "changed": 1, "only_a": 1, "only_b": 1}
    assert cli.main(["diff", str(tmp_path / "manifest_occ.json"), str(tmp_path / "manifest_occ.json")]) == 0
    told = cli.info(spark, str(tmp_path))
    assert told["manifests"] == {k: {"entries": 3, "count": 3, "bytes": 6, "generator": {}} for k in ("nuscenes", "occ")} and told["tables"] == told["files"] == {}


def test_registry(tmp_path, monkeypatch):
    with pytest.raises(KeyError):
        registry.product("none", "occ")
    with pytest.raises(KeyError):
        registry.product("sunrgbd", "none")
    (tmp_path / "c.json").write_text('{"sunrgbd": {"root": "/x"}}')
    monkeypatch.setenv("DEPTHLOOM_CONFIG", str(tmp_path / "c.json"))
    assert registry.dataset_paths("sunrgbd") == {"root": "/x"}
