"""Training-data operators: filters, de-duplication, decontamination, packing.

Nothing outside this package imports it. ``queries`` lists the registered
queries; every operator module keeps its own general interface.
"""
