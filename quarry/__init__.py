"""quarry — Spark-native analytics workflows.

Four batch workflows re-expressed as DataFrame operators:

* web-log analytics  (:mod:`quarry.operators.weblog`)
* recommendation     (:mod:`quarry.operators.recsys`)
* classification     (:mod:`quarry.operators.tuning`)
* claims regression  (:mod:`quarry.operators.regression`, :mod:`quarry.operators.tabular`)

Every operator takes DataFrames and returns DataFrames; nothing passes whole
through the driver.
"""

__version__ = "0.1.0"
