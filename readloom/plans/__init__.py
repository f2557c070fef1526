"""readloom.plans"""
