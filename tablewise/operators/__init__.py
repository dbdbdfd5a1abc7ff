"""Operators.

profile   D1-D16   one-scan column profile, also grouped
slices    B5-B9    time slots as pushed-down half-open ranges, day labels, newest slot
features  B12-B18  feature plan and encoding for the drift classifier
suggest   E1-E13   constraint suggestion rules and their check
sampling  F1-F7    per-class and bounded samples, exact stratified split
corrupt   X1-X6    hash-based error injection
metrics   M4-M8    confusion rates, exact AUC, metric rows (M11)
drift     M1-M3    GBT two-sample classifier with metrics and SHAP (M12 time stamps)
shap      M9-M10   TreeSHAP over Spark GBT trees, mean absolute SHAP
"""
