from candela.functions.signals import signals


def sig_rows(spark, sma5, sma20, rsi, macd, sig):
    df = spark.createDataFrame([("T", "2020-01-01", sma5, sma20, rsi, macd, sig)],
                               "ticker string, date string, sma_5 double, sma_20 double, "
                               "rsi_14 double, macd double, macd_signal double")
    return [(r.signal_type, r.signal_strength, r.signal_source)
            for r in signals(df).orderBy("signal_rank").collect()]


def test_all_neutral_is_hold(spark):
    assert sig_rows(spark, 1.0, 1.0, 50.0, 0.5, 0.5) == [("HOLD", 50.0, "COMBINED")]


def test_rsi_limits_are_strict(spark):
    assert sig_rows(spark, 1.0, 1.0, 30.0, 0.5, 0.5) == [("HOLD", 50.0, "COMBINED")]
    assert sig_rows(spark, 1.0, 1.0, 70.0, 0.5, 0.5) == [("HOLD", 50.0, "COMBINED")]


def test_three_rules_in_order(spark):
    assert sig_rows(spark, 2.0, 1.0, 25.0, 0.1, 0.2) == [
        ("BUY", 80.0, "SMA_CROSS"), ("BUY", 75.0, "RSI"), ("SELL", 75.0, "MACD")]


def test_description_text(spark):
    df = spark.createDataFrame([("T", "d", 1.0, 1.0, 80.123, 0.0, 0.0)],
                               "ticker string, date string, sma_5 double, sma_20 double, "
                               "rsi_14 double, macd double, macd_signal double")
    r = signals(df).first()
    assert r.description == "Overbought condition: RSI = 80.12"
    assert abs(r.signal_strength - 80.123) < 1e-9
