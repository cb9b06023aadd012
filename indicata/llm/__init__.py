"""Operations of a training-data pipeline on document tables.

Each module holds one operator (``DataFrame -> DataFrame``); ``queries``
registers one query per operator. Nothing else in the library imports this
subpackage.
"""
