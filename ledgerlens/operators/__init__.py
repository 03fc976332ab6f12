"""Operators: functions from DataFrames to a DataFrame.

``preprocess`` (slim logs, users, labels), ``stats`` and ``features``
(amount, day and hour statistics), ``type_index`` (dictionaries, top
types), ``sequences`` (daily sequences, tokens, follow rates), ``rules``
(dominant followers, flags), ``merge`` (feature table and its text form),
``model`` (decision tree).
"""
