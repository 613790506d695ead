"""The two models, the marts, the reports and the audits."""
