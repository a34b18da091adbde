from cadence.session import sizing


def test_sizing_for_100_tb_on_1000_executors():
    s = sizing(100 * 10**12, total_cores=8000)
    partitions = int(s["spark.sql.shuffle.partitions"])
    assert partitions % 8000 == 0
    assert 100 * 10**12 / partitions <= 128 << 20
    assert s["spark.sql.files.maxPartitionBytes"] == str(128 << 20)


def test_sizing_small_input_is_one_wave():
    assert sizing(10 << 20, total_cores=8)["spark.sql.shuffle.partitions"] == "8"
