"""No streaming operators.

The modelled workload is batch only: order histories are read as tables, features are built,
models are trained and decisions are written. There is no watermark, window over event time,
state or late data anywhere in it, so nothing is invented here.
"""
