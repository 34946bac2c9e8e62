"""Config-driven job: both summaries written for every level."""

import glob
import json

from ballotlake.plans.jobs import run_elections, write_name_map
from tests.conftest import write
from tests.test_ballots import HEADER, ROWS
from tests.test_results import T2


def test_run_elections(spark, tmp_path):
    write(str(tmp_path / "abs/a.csv"), HEADER + "\n".join(ROWS) + "\n")
    write(str(tmp_path / "res.csv"), T2)
    write(str(tmp_path / "map.csv"), "county,precinct,mapPrecinctName,electionResultsPrecinctName,score\n"
                                      "FULTON,A-1,Alpha,Alpha,100\n")
    cfg = [{"name": "2024_general", "date": "2024-11-05", "absenteeSummarize": True,
            "absenteeFiles": str(tmp_path / "abs/*.csv"), "resultsSummarize": True,
            "resultsDownloadFile": str(tmp_path / "res.csv"),
            "resultsPrecinctNameToMapFile": str(tmp_path / "map.csv")},
           {"name": "off", "date": "2022-11-08", "absenteeSummarize": False, "resultsSummarize": False}]
    cpath = write(str(tmp_path / "config.json"), json.dumps(cfg))
    out = run_elections(spark, cpath, str(tmp_path / "out"))
    assert len(out) == 10            # three levels each, and the reports
    doc = [json.loads(ln) for f in glob.glob(out[2] + "/part-*") for ln in open(f)]       # absentee statewide
    assert len(doc) == 1 and doc[0]["votesByDay"][-1]["votesToDate"] == 7
    m = spark.createDataFrame([("FULTON", "A-1", "Alpha", "Alpha", 87)], "county string, precinct string, "
                              "mapPrecinctName string, electionResultsPrecinctName string, score int")
    write_name_map(m, str(tmp_path / "nm"))
    lines = [ln for f in glob.glob(str(tmp_path / "nm/part-*.csv")) for ln in open(f).read().splitlines()]
    assert '"FULTON","A-1","Alpha","Alpha","87.00"' in lines
