import csv
import json

from addrloom import cli


def table(path, rows):
    with open(path, "w", newline="", encoding="utf-8-sig") as f:
        csv.writer(f).writerows(rows)


def test_a_file_runs_through_all_stages(spark, tmp_path):
    masters = tmp_path / "masters"
    masters.mkdir()
    table(masters / "india_post.csv", [["Pincode", "StateName", "District", "OfficeName"], ["122001", "Haryana", "Gurgaon", "Sector 12"], ["302001", "Rajasthan", "Jaipur", "Jaipur City"]])
    table(masters / "district.csv", [["District Code", "District Name (In English)"], ["58", "Gurugram"], ["1", "Jaipur"]])
    table(masters / "subdistrict.csv", [["District Code", "District Name", "Subdistrict Code", "Subdistrict Name"], ["58", "Gurugram", "360", "Sohna"]])
    table(masters / "village.csv", [["District Code", "District Name", "Sub-District Code", "Sub-District Name", "Village Code", "Village Name"], ["58", "Gurugram", "360", "Sohna", "63001", "Rampur"]])
    table(masters / "ulb.csv", [["Local Body Code", "Local Body Name"], ["800001", "Gurugram"]])
    (tmp_path / "in").mkdir()
    table(tmp_path / "in" / "a.csv", [["LAN", "Address", "Town"], ["7", "H-338, MG ROAD, SECTOR 12, GURUGRAM, HARYANA 122001", "0"], ["", "dropped", ""], ["8", "", ""]])
    (tmp_path / "layouts.json").write_text(json.dumps({"X": {"signature": ["LAN", "Address"], "lan": ["LAN"], "current": ["Address", "Town"]}}))
    cli.main(["run", "--input", str(tmp_path / "in"), "--masters", str(masters), "--layouts", str(tmp_path / "layouts.json"), "--output", str(tmp_path / "out")])
    final = {r.lan: r for r in spark.read.option("header", True).csv(f"{tmp_path}/out/final").collect()}
    assert set(final) == {"'7'", "'8'"} and final["'7'"].current_clean_address.endswith("HARYANA, 122001") and final["'8'"].current_quality_class == "INVALID"
    assert (final["'7'"].current_quality_class, float(final["'7'"].current_raw_quality_score)) == ("USABLE", 72.0)  # a state takes the hyphen of H-338 along
    audit = {r.lan: r for r in spark.read.option("header", True).csv(f"{tmp_path}/out/audit").collect()}
    assert audit["'8'"].current_remark.startswith("Missing: Complete Address")
