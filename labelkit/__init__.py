"""labelkit: labelled short-text classification on Spark (DataFrame + Spark ML).

Modules:

* ``labelkit.sources.lines``     - ``name;label`` text files: read, drop header, parse, load
* ``labelkit.functions.text``    - Column -> Column helpers (clean, first word, length, filters)
* ``labelkit.operators.features`` - the stateless feature chain (clean, tokenize, stop words, hash)
* ``labelkit.operators.models``  - fit (one or several models sharing passes), save, load, load-or-train
* ``labelkit.operators.score``   - scoring and ``predict_names`` over whole tables
* ``labelkit.operators.evaluate`` - accuracy / weighted precision / recall / F1 in one pass
* ``labelkit.operators.split``   - repeatable hash split
* ``labelkit.operators.summary`` - counts, label shares, length statistics and histogram
* ``labelkit.operators.limits``  - ordered first rows
* ``labelkit.operators.compare`` - metric table and one-pass two-model comparison
* ``labelkit.plans``             - end-to-end plans (driver tables, names files), query catalog, SQL checks
* ``labelkit.streaming.scoring`` - the scorer on a streaming DataFrame
* ``python -m labelkit``         - command line: train / predict
"""
